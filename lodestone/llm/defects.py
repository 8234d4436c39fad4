"""Responses that do not serve as answers (problem 5).

Method: the response is cut into clauses; a linear-chain conditional random field tags every clause as answer, refusal,
echo, foreign or unfinished; the share of the response's letters under each tag decides the defect of the pair.

What the field sees of a clause: how its words and pairs of words are spread over refusals and other clauses (weights of
hashed n-grams), how much of it stands in the question and in the context, its language by profiles of letter triples
(:mod:`lodestone.llm.languages`), how it ends, whether corpus-wide evidence says that the value was cut (the truncation
operator), and its place. No list of phrases is looked up. The weights (``defect_weights.json``) were fitted once by
:mod:`lodestone.llm.fit_defects` on a bounded sample; they are a constant of the library, so a row's tags depend on that
row alone, and on the verdict about its end.

Texts move in no shuffle: a row is tagged where it is read, once as whole and once as cut where its end leaves that
open, and the truncation operator's verdict, joined on the row's number, picks one of the two.

A row has at most one defect, the first that holds of: empty, truncated, copy, refusal, language.

Defined cases: a null, empty or blank response, or one that only says that there is none, is ``empty``; a null or empty
instruction has no language and cannot be copied; an instruction that names a language asks for one; a response too
short to tell, and code or data, has no language; equal rows get equal defects; very long responses are tagged whole;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import pkgutil
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import truncation
from lodestone.llm.languages import language, script
from lodestone.session import materialize

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
FEATURES = ("bias", "refusing", "refusing_some", "echo_most", "echo_some", "asked_again", "other_language", "own_language", "grounded", "cut", "open_end", "joined_end", "first", "last", "short", "quoted")
WEIGHTS = Path(__file__).with_name("defect_weights.json")
# At most so many rows are used to fit the field.
FIT_ROWS = 30_000
# Longer ones are not used to fit it; they are tagged like all others.
FIT_CLAUSES = 12
GRAMS = 1 << 13
COVERED, COPIED = 0.6, 0.8
# A response of fewer letters shows no language.
LEAST_LETTERS = 25

# What stands in for an answer that is not there, as letters and digits only.
_PLACEHOLDERS = frozenset("na none null nil tbd todo tba empty noneprovided noanswer noresponse notavailable notapplicable nan undefined nooutput emptyresponse missing blank pending unknown noresponseprovided noanswerprovided keineantwort keine sansreponse sansréponse aucune sinrespuesta ninguna placeholder xxx".split())
_WORD = re.compile(r"[^\W_]+(?:['’][^\W\d_]+)?")
_CLAUSE = re.compile(r"(?<=[.!?。！？])[\"'”’»)*_]*\s+|(?<=[。！？])|\n+")
_ASKED = re.compile(r"[.!?:;…。！？«»\"“”„\n]+")
_STOP = re.compile(r"[.!?。！？][\"'”’»)\]*_`]*\s*$")
_JOINED = re.compile(r"[,;:(\[{/&=–—-]\s*$")
# Names of languages and the word for translating them, in the languages that are known.
_ASKS_LANGUAGE = re.compile(
    r"translat|übersetz|tradui|traduc|traduz|tradurre|vertaal|översätt|przetłumacz|çevir|terjemah"
    r"|\b(?:english|german|french|spanish|italian|portuguese|dutch|swedish|polish|turkish|chinese|japanese|russian|arabic|englisch\w*|deutsch\w*|französisch\w*|spanisch\w*|italienisch\w*|portugiesisch\w*"
    r"|anglais\w*|allemand\w*|français\w*|espagnol\w*|italien\w*|portugais\w*|inglés|alemán|francés|español|italiano|portugués|inglese|tedesco|francese|spagnolo|inglês|alemão|francês|espanhol|engels|duits|frans|spaans)\b"
)


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:])) or [(w, "") for w in words]


def _share(grams: list, of: set) -> float:
    return len([1 for x in grams if x in of]) / len(grams)


def is_empty(response: str | None) -> bool:
    if response is None:
        return True
    s = "".join(c for c in response.lower() if c.isalnum())
    return not s or s in _PLACEHOLDERS


def clauses(response: str) -> list[str]:
    return [c for c in _CLAUSE.split(response) if c and _WORD.search(c)]


def gram(*words: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words)) & (GRAMS - 1)


@functools.lru_cache(maxsize=1)
def _parameters() -> dict:
    return json.loads(pkgutil.get_data(__package__, WEIGHTS.name))


@functools.lru_cache(maxsize=1)
def weights() -> tuple[np.ndarray, np.ndarray]:
    w = _parameters()
    return np.array(w["emit"]), np.array(w["move"])


@functools.lru_cache(maxsize=1)
def gram_weights() -> list[float]:
    w = _parameters()
    return [w["gram_bias"], *np.frombuffer(base64.b64decode(w["grams"]), dtype="<f2").astype(float).tolist()]


def forget_weights() -> None:
    for f in (_parameters, weights, gram_weights, _gram_weight):
        f.cache_clear()


@functools.lru_cache(maxsize=200_000)
def _gram_weight(a: str, b: str) -> float:
    w = gram_weights()
    return w[1 + gram(a, b)] + w[1 + gram(b)]


def refusing(words: list[str]) -> float:
    """Log odds that a clause of these words refuses, from its words and pairs of words, held between -1 and 1."""
    padded = ["^", *words, "$"]
    total = sum(map(_gram_weight, padded, padded[1:])) / (len(words) + 1) ** 0.5 + gram_weights()[0]
    return max(-1.0, min(1.0, total / 4.0))


class Pair:
    """The clauses of a response with their features."""

    __slots__ = ("features", "sizes")

    def __init__(self, instruction: str | None, response: str, cut: bool, context: str | None = None):
        ask = instruction or ""
        asked = _words(ask)
        pairs = set(_bigrams(asked)) if asked else set()
        parts = clauses(response)
        words = [_words(c) for c in parts]
        grams = [_bigrams(w) for w in words]
        given = {x for g in grams for x in g}
        # Only a response that repeats every clause of the question repeats the question.
        tasks = [g for w in map(_words, _ASKED.split(ask)) if len(w) > 2 for g in [_bigrams(w)]] or ([_bigrams(asked)] if asked else [])
        again = bool(tasks) and bool(given) and min(_share(g, given) for g in tasks) >= 0.5
        held = set(_bigrams(_words(context))) if context and parts else set()
        own = None if _ASKS_LANGUAGE.search(ask.lower()) else script(ask) or language(asked)
        spoken = self._spoken(response, words) if own else None
        self.features, self.sizes = [], []
        for k, (c, w, g) in enumerate(zip(parts, words, grams)):
            echo = _share(g, pairs) if pairs else 0.0
            lang = spoken
            if spoken and spoken != own:
                # A clause on its own may be of the instruction's language.
                lang = script(c) or language(w) or spoken
            last = k == len(parts) - 1
            r = refusing(w)
            self.features.append(
                (
                    1.0, r, r > 0, echo >= 0.7 and len(w) > 2, 0.3 <= echo < 0.7, again and echo >= 0.7, lang is not None and lang != own, lang is not None and lang == own,
                    bool(held) and _share(g, held) >= 0.5, cut and last, last and not _STOP.search(c), last and _JOINED.search(c) is not None, k == 0, last, len(w) < 4, c[0] in "\"“«„'",
                )
            )
            self.sizes.append(len(c))

    @staticmethod
    def _spoken(response: str, words: list[list[str]]) -> str | None:
        # Code and data have words of their own.
        if response.lstrip()[:1] in "{[<" or "```" in response or truncation._CODE.search(response):
            return None
        flat = [x for w in words for x in w]
        if (other := script(response)) is not None:
            return other
        return language(flat) if sum(map(len, flat)) >= LEAST_LETTERS else None


def _padded(pairs: list[Pair]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(p.features) for p in pairs])
    x = np.zeros((len(pairs), max(n, default=0), len(FEATURES)))
    for i, p in enumerate(pairs):
        if p.features:
            x[i, : n[i]] = p.features
    return x, n


def decode(pairs: list[Pair]) -> list[list[int]]:
    """Best tag sequence of each pair (Viterbi), over batches of pairs of similar length."""
    emit, move = weights()
    order = sorted(range(len(pairs)), key=lambda i: len(pairs[i].features))
    out: list[list[int]] = [[] for _ in pairs]
    for at in range(0, len(order), 256):
        ids = order[at : at + 256]
        x, n = _padded([pairs[i] for i in ids])
        if not x.shape[1]:
            continue
        e = x @ emit.T
        score, back = e[:, 0], np.zeros((len(ids), x.shape[1], len(TAGS)), dtype=np.int8)
        finals = [score]
        for t in range(1, x.shape[1]):
            step = score[:, :, None] + move[None]
            back[:, t] = step.argmax(1)
            score = step.max(1) + e[:, t]
            finals.append(score)
        for j, i in enumerate(ids):
            if n[j]:
                tag = int(finals[n[j] - 1][j].argmax())
                tags = [tag]
                for t in range(n[j] - 1, 0, -1):
                    tag = int(back[j, t, tag])
                    tags.append(tag)
                out[i] = tags[::-1]
    return out


def fit(pairs: list[Pair], labels: list[list[int]], rounds: int = 60, rate: float = 0.5, shrink: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights that maximise the regularised conditional log likelihood (gradient ascent with Adagrad)."""
    kept = [(p, y) for p, y in zip(pairs, labels) if y and len(y) <= FIT_CLAUSES]
    x, n = _padded([p for p, _ in kept])
    y = np.zeros(x.shape[:2], dtype=int)
    for i, (_, t) in enumerate(kept):
        y[i, : len(t)] = t
    k, steps = len(TAGS), x.shape[1]
    # Defects are rare, so a pair with any counts ten times.
    v = np.array([10.0 if any(t) else 1.0 for _, t in kept])
    v /= v.sum()
    mask = (np.arange(steps)[None] < n[:, None]) * v[:, None]
    inside = mask > 0
    hot = np.eye(k)[y] * mask[..., None]
    seen_e = np.einsum("ntk,ntf->kf", hot, x)
    seen_m = np.einsum("nta,ntb->ab", hot[:, :-1] > 0, hot[:, 1:])
    emit, move = np.zeros((k, len(FEATURES))), np.zeros((k, k))
    ge, gm = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    for _ in range(rounds):
        e = x @ emit.T
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, steps):
            a = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move[None], axis=1) + e[:, t]
            alpha[:, t] = np.where(inside[:, t, None], a, alpha[:, t - 1])
        for t in range(steps - 2, -1, -1):
            b = np.logaddexp.reduce(move[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(inside[:, t + 1, None], b, 0.0)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        node = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        exp_m = np.zeros_like(move)
        for t in range(steps - 1):
            pair = np.exp(alpha[:, t, :, None] + move[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :] - z[:, None, None])
            exp_m += (pair * mask[:, t + 1, None, None]).sum(0)
        de = seen_e - np.einsum("ntk,ntf->kf", node, x) - shrink * emit
        dm = seen_m - exp_m - shrink * move
        ge += de**2
        gm += dm**2
        emit += rate * de / np.sqrt(ge)
        move += rate * dm / np.sqrt(gm)
    return emit, move


def defect_of(pair: Pair, tags: list[int]) -> str | None:
    """The defect by the share of letters under each tag; a cut end is one wherever it is."""
    total = sum(pair.sizes)
    if not total:
        return None
    share = [0.0] * len(TAGS)
    for t, n in zip(tags, pair.sizes):
        share[t] += n / total
    if share[4] > 0:
        return "truncated"
    if share[2] >= COPIED:
        return "copy"
    if share[1] >= COVERED:
        return "refusal"
    if share[3] >= COVERED:
        return "language"
    return None


def tagged(rows: DataFrame) -> DataFrame:
    """``rec_idx, whole, cut``: the defect of each row if its end is whole, and if it is cut, where there is any.

    A row whose end looks whole in itself may be cut by corpus-wide evidence, so both are always told; the field is run
    a second time only where the answer could differ.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, whole, cut, pairs = [], [], [], []
            for idx, ask, context, answer in zip(*(c.to_pylist() for c in b.columns)):
                if is_empty(answer):
                    ids.append(idx)
                    whole.append("empty")
                    cut.append("empty")
                else:
                    pairs.append((idx, Pair(ask, answer, False, context)))
            found = [defect_of(p, tags) for (_, p), tags in zip(pairs, decode([p for _, p in pairs]))]
            at = FEATURES.index("cut")
            for _, p in pairs:
                if p.features:
                    p.features[-1] = (*p.features[-1][:at], True, *p.features[-1][at + 1 :])
            for (idx, p), plain, tags in zip(pairs, found, decode([p for _, p in pairs])):
                if_cut = defect_of(p, tags)
                if plain or if_cut != "truncated":
                    ids.append(idx)
                    whole.append(plain)
                    cut.append(if_cut)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(whole, pa.string()), pa.array(cut, pa.string())], names=["rec_idx", "whole", "cut"])

    return rows.select("rec_idx", "instruction", "context", "response").mapInArrow(run, "rec_idx bigint, whole string, cut string")


def defects(raw: DataFrame, log: DataFrame) -> DataFrame:
    """``rec_idx, defect`` for each defective row of ``raw``."""
    ends = truncation.truncated(raw, log).where("field_name = 'response'").select(F.col("row_key").alias("rec_idx")).distinct()
    ends = materialize(ends.withColumn("is_cut", F.lit(True)), "p5-cut")
    rows = materialize(tagged(raw.select(F.col("_idx").cast("bigint").alias("rec_idx"), "instruction", "context", "response")), "p5-tags")
    # Rows that are not in ``rows`` have no defect if whole and are truncated if cut.
    known = rows.join(ends, "rec_idx", "left").select("rec_idx", F.when(F.col("is_cut"), F.col("cut")).otherwise(F.col("whole")).alias("defect"))
    rest = ends.join(rows, "rec_idx", "left_anti").select("rec_idx", F.lit("truncated").alias("defect"))
    return known.where("defect is not null").unionByName(rest)
