"""The language of a text by profiles of letter triples.

``languages.txt`` holds one passage of general text for each language that is known; a profile is the smoothed frequency
of each triple of letters (with word borders) in it. Texts in another script than Latin have the script as language.
"""

from __future__ import annotations

import functools
import math
import pkgutil
import re
import unicodedata
from collections import Counter

SMOOTH = 0.3
STEP, FIELD = 64, 48
# Letters outside the Latin blocks.
_OTHER = re.compile(r"[^\W\d_A-\u024f\u1e00-\u1eff]")
# Words whose costs are kept between rows; the store is emptied when full, which changes no result.
HELD = 200_000
# By how much, a letter, the best language has to lead the second.
LEAD = 0.09


def _triples(word: str) -> list[str]:
    w = f" {word} "
    return [w[i : i + 3] for i in range(len(w) - 2)]


@functools.lru_cache(maxsize=1)
def profiles() -> tuple[tuple[str, ...], dict[str, int], int]:
    """Languages, the cost of each known triple in each, and that of unknown ones.

    A cost is a negative log-likelihood in steps of 1 / STEP. The costs of all languages stand in one integer, FIELD bits
    each, so that texts are scored by adding integers.
    """
    names, counts = [], []
    for line in pkgutil.get_data(__package__, "languages.txt").decode("utf-8").splitlines():
        name, _, text = line.partition("\t")
        names.append(name)
        counts.append(Counter(t for w in "".join(c if c.isalpha() else " " for c in text.lower()).split() for t in _triples(w)))
    known = sorted(set().union(*counts))
    totals = [sum(c.values()) + SMOOTH * len(known) for c in counts]
    packed = lambda t: sum(round(-math.log((c[t] + SMOOTH) / n) * STEP) << FIELD * k for k, (c, n) in enumerate(zip(counts, totals)))
    return tuple(names), {t: packed(t) for t in known}, packed("")


_held: dict[str, int] = {}


def word_cost(word: str) -> int:
    """The costs of a lower-case word; words with digits say nothing."""
    _, cost, unknown = profiles()
    if len(_held) >= HELD:
        _held.clear()
    c = _held[word] = sum(cost.get(t, unknown) for t in _triples(word)) if word.isalpha() else 0
    return c


def language(words: list[str], lead: float = LEAD) -> str | None:
    """The language of lower-case words, or null where none leads clearly."""
    size = len(words) + sum(map(len, words))
    if size < 12:
        return None
    total, get = 0, _held.get
    for w in words:
        c = get(w)
        total += word_cost(w) if c is None else c
    names = profiles()[0]
    costs = [total >> FIELD * k & (1 << FIELD) - 1 for k in range(len(names))]
    best, second = sorted(costs)[:2]
    return names[costs.index(best)] if second - best >= lead * size * STEP else None


def script(text: str) -> str | None:
    """The script of most letters if it is not Latin: the first word of its characters' names."""
    if text.isascii() or not (other := _OTHER.findall(text)):
        return None
    if len(other) * 2 <= sum(map(str.isalpha, text)):
        return None
    return Counter(unicodedata.name(c, "UNKNOWN").split()[0] for c in other).most_common(1)[0][0]
