"""Fit the clause field on a bounded sample of rows and write its weights: python -m lodestone.llm.fit_defects FOLDER.

No labels exist, so each tag is learned from evidence that the field itself does not look at:

* refusal: clauses that come as whole responses to many unlike instructions, word for word but for rare words (at most
  ``FIT_ROWS`` rows are read), and the sentences of ``refusals.txt``;
* echo: responses that equal the instruction, from its beginning on, in the order of all words but for a few (a
  sequence match);
* foreign: clauses whose function words are of another language than the instruction's;
* unfinished: whole responses that are cut here at a random letter.
"""

from __future__ import annotations

import base64
import difflib
import json
import pkgutil
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from lodestone.llm import defects as D
from lodestone.llm import truncation

RARE, UNLIKE, STOCK_CLAUSES, STOCK_WORDS, SAME = 40, 5, 3, 5, 0.85
FUNCTION_WORDS = {
    "en": "a an i me my about should do does did can could would some any they we all the of and is are was were that this with for by on in to it at from not no why how what who which than then as be has have it's you your so under until while because if only there of them became would say says",
    "de": "der die das und ist sind war nicht ein eine einen dass mit von für wenn weil auf im am den dem des zu zum zur sich auch schon noch wieder wird hat es bis nach über ohne unter während sagen sagt davon warum wie wer was ob aber sehr seit zwischen",
    "fr": "le la les des est sont était que une un dans pour pas du et sur selon avec sans qui pourquoi comment ce cette il elle ne l'une au aux plus alors soit reste en de à mais comme pendant après avant malgré si fallu heures dit disent cela déjà quel vous",
    "es": "el la los las que es son era una un por para con del y según sin quién qué cómo cuando mientras entonces pero hay su se de en al lo fue volvió ya hasta sigue dice más durante después antes si ello razones esta este cuál",
}
_OF = {x: sum(w in v.split() for w in [x] for v in FUNCTION_WORDS.values()) for v in FUNCTION_WORDS.values() for x in v.split()}
_SETS = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}


def spoken(words: list[str]) -> str | None:
    """The language whose function words a text has clearly most of."""
    score = {k: sum(1.0 if _OF[w] == 1 else 0.25 for w in words if w in s) for k, s in _SETS.items()}
    best, second = sorted(score, key=score.get)[-1:-3:-1]
    return best if score[best] >= max(2.0, 1.5 * score[second], 0.05 * len(words)) else None


def stock(rows: list[dict]) -> list[bool]:
    """Which responses are made only of clauses that answer many unlike instructions alike."""
    cut = [[D._words(c) for c in D.clauses(r["response"])] for r in rows]
    often = Counter(w for c in cut for w in {x for ws in c for x in ws})
    form = lambda ws: " ".join("0" if w.isdigit() else w if often[w] >= RARE else "*" for w in ws)
    asked: dict[str, set] = defaultdict(set)
    for r, c in zip(rows, cut):
        if 1 <= len(c) <= STOCK_CLAUSES:
            for ws in c:
                asked[form(ws)].add(" ".join(D._words(r["instruction"] or "")[:6]))
    known = {f for f, s in asked.items() if len(s) >= UNLIKE and not f.replace("*", "").strip() == ""}
    return [1 <= len(c) <= STOCK_CLAUSES and len(c[0]) >= STOCK_WORDS and all(form(ws) in known for ws in c) for c in cut]


def copied(row: dict) -> bool:
    a, b = D._words(row["instruction"] or ""), D._words(row["response"])
    if not a or not 0.7 < len(b) / len(a) < 1.5 or len(set(a[:4]) - set(b[:8])) > 1:
        return False
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() >= SAME


def fit_grams(texts: list[list[str]], labels: list[float], weight: list[float], rounds: int = 150, shrink: float = 2e-6) -> tuple[float, np.ndarray]:
    """Logistic regression on hashed words and pairs of words (Adagrad)."""
    at, row = [], []
    for k, ws in enumerate(texts):
        padded = ["^", *ws, "$"]
        for a, b in zip(padded, padded[1:]):
            at += [D.gram(a, b), D.gram(b)]
            row += [k, k]
    at, row = np.array(at), np.array(row)
    scale = 1.0 / np.sqrt(np.array([len(t) + 1 for t in texts]))
    y, v = np.array(labels), np.array(weight)
    v = v / v.sum()
    w, bias, g2, b2 = np.zeros(D.GRAMS), 0.0, np.full(D.GRAMS, 1e-10), 1e-10
    for _ in range(rounds):
        z = np.bincount(row, w[at], len(texts)) * scale + bias
        e = v * (y - 1 / (1 + np.exp(-z)))
        g = np.bincount(at, (e * scale)[row], D.GRAMS) - shrink * w
        g2 += g**2
        b2 += e.sum() ** 2
        w += 0.5 * g / np.sqrt(g2)
        bias += 0.5 * e.sum() / b2**0.5
    return bias, w


def main(folder: str) -> None:
    rng = random.Random(5)
    t = pq.read_table(f"{folder}/raw_instructions.parquet", columns=["instruction", "context", "response"]).slice(0, D.FIT_ROWS)
    rows = [r for r in t.to_pylist() if not D.is_empty(r["response"]) and truncation.inspect(r["response"])[0] != truncation.CUT]
    again = [copied(r) for r in rows]
    refused = [s and not a for s, a in zip(stock(rows), again)]
    # The n-grams: clauses of stock responses against all others; every fifth row is held out.
    texts, labels, weight = [], [], []
    for i, (r, y) in enumerate(zip(rows, refused)):
        if i % 5:
            for c in D.clauses(r["response"]):
                texts.append(D._words(c))
                labels.append(float(y))
                weight.append(20.0 if y else 1.0)
    for line in pkgutil.get_data("lodestone.llm", "refusals.txt").decode("utf-8").splitlines():
        sign, _, sentence = line.partition("\t")
        texts.append(D._words(sentence))
        labels.append(float(sign == "+"))
        weight.append(60.0)
    bias, grams = fit_grams(texts, labels, weight)
    start = {"emit": [], "move": [], "gram_bias": round(float(bias), 4), "grams": base64.b64encode(grams.astype("<f2").tobytes()).decode()}
    D.WEIGHTS.write_text(json.dumps(start) + "\n")
    D.forget_weights()
    pairs, tags = [], []
    for r, no, echo in zip(rows, refused, again):
        own = None if D._ASKS_LANGUAGE.search((r["instruction"] or "").lower()) else spoken(D._words(r["instruction"] or ""))
        whole = spoken(D._words(r["response"]))
        other = own and whole and own != whole and "```" not in r["response"] and not truncation._CODE.search(r["response"])
        parts = D.clauses(r["response"])
        y = [1 if no else 2 if echo else 3 if other and (spoken(D._words(c)) or whole) != own else 0 for c in parts]
        pairs.append(D.Pair(r["instruction"], r["response"], False, r["context"]))
        tags.append(y)
        if len(parts) > 1 and (any(y) or rng.random() < 0.1):
            # Responses of one clause, which the sample has too few of.
            k = rng.randrange(len(parts))
            pairs.append(D.Pair(r["instruction"], parts[k], False, r["context"]))
            tags.append([y[k]] * len(D.clauses(parts[k])))
        if rng.random() < 0.15 and len(r["response"]) > 60 and not any(y):
            short = r["response"].strip()[: rng.randrange(20, len(r["response"].strip()) - 8)].rstrip()
            if short[-1:].isalnum() and len(cut := D.clauses(short)):
                pairs.append(D.Pair(r["instruction"], short, rng.random() < 0.97, r["context"]))
                tags.append([0] * (len(cut) - 1) + [4])
    train = [i for i in range(len(pairs)) if i % 5]
    emit, move = D.fit([pairs[i] for i in train], [tags[i] for i in train])
    short = lambda m: [[round(float(x), 4) for x in r] for r in m]
    D.WEIGHTS.write_text(json.dumps(start | {"emit": short(emit), "move": short(move)}) + "\n")
    D.forget_weights()
    held = [i for i in range(len(pairs)) if not i % 5]
    got = D.decode([pairs[i] for i in held])
    right = [(a, b) for i, g in zip(held, got) for a, b in zip(g, tags[i])]
    print(f"held-out clause accuracy {sum(a == b for a, b in right) / len(right):.4f} over {len(right)} clauses")
    for k, tag in enumerate(D.TAGS):
        hit, said, true = sum(a == b == k for a, b in right), sum(a == k for a, _ in right), sum(b == k for _, b in right)
        print(f"{tag}: precision {hit / max(said, 1):.3f}, recall {hit / max(true, 1):.3f}, {true} clauses")


if __name__ == "__main__":
    main(sys.argv[1])
