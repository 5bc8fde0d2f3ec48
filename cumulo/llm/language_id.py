"""Language ID by multilingual mixture inference.

Each language is a distribution over hashed character trigrams (letters lower-cased, everything else
a blank; a trigram counts where its middle is a letter), learned from all labelled training texts:
the counts are summed per language in Spark and the model is `2**bits` numbers per language.

A document is a mixture: trigram g has probability sum_l share[l] * p_l(g). For a set of languages,
expectation-maximisation finds the shares of highest likelihood. The set is grown from the best
single language: the language with the largest gain joins as long as the log-likelihood rises by
more than `penalty * ln(n) / 2` (n trigrams; `penalty` above 1 because neighbouring trigrams
overlap). A language whose share cannot rise from zero (the likelihood's slope there is not
positive) is not tried.

The score is the predicted language's share or, of a text in one language, its posterior probability
against the other languages (tempered by the same overlap), so short texts score lower.

Defined cases: NULL text and text without a letter give `und`, score 0, no shares; with no training
text every document does; ties go to the language first in the alphabet; ids are passed through, so
repeated and NULL ids give one row each; an empty table gives an empty result; columns other than
those named are not looked at, and predictions see the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cumulo.llm.common import materialise, tidy

UND = "und"
BITS = 15
PENALTY = 6.0
OVERLAP = 3.0
ROUNDS = 40
MAX_LANGS = 500  # at most 64 MB of model
MIN_KNOWN = 0.2
MIN_GRAMS = 100


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_LETTER = None


def trigrams(text: str, bits: int = BITS) -> np.ndarray:
    """Hashed trigrams around each letter of a text."""
    global _LETTER
    if _LETTER is None:
        _LETTER = _letters()
    code = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _LETTER[code]
    at = np.flatnonzero(letter)
    if not len(at):
        return at
    code = np.concatenate(([0], np.where(letter, code, 0), [0])).astype(np.uint32)
    h = code[at] * np.uint32(0x85EBCA6B) ^ code[at + 1] * np.uint32(0xC2B2AE35) ^ code[at + 2] * np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = BITS,
          max_langs: int = MAX_LANGS) -> dict[str, np.ndarray]:
    """Trigram probabilities per language from all labelled rows (NULL labels and texts are left out).

    The model goes to every task, 2**bits numbers a language; more than `max_langs` languages raise."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("l").to_pylist(), b.column("t").to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(1 << bits, np.int64)
                seen[lang] += np.bincount(trigrams(text, bits), minlength=1 << bits)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(n[at], pa.int64())], ["lang", "gram", "n"])

    rows = labelled.select(F.col(f"`{lang_col}`").alias("l"), F.col(f"`{text_col}`").alias("t")).dropna()
    total = rows.mapInArrow(tidy(count), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = materialise(total, "trigrams")
    n_langs = total.select("lang").distinct().count()
    if n_langs > max_langs:
        raise ValueError(f"{n_langs} languages; the model is bounded to {max_langs}")
    model: dict[str, np.ndarray] = {}
    for r in total.toLocalIterator():  # at most 2**bits rows for a language
        model.setdefault(r.lang, np.zeros(1 << bits))[r.gram] = r.n
    return {lang: ((n + 0.5) / (n.sum() + 0.5 * len(n))).astype(np.float32) for lang, n in sorted(model.items())}


def _fit(p: np.ndarray, n: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """EM for the shares. p: grams x languages, n: count of each gram."""
    total = n.sum()
    for _ in range(ROUNDS):
        mix = p @ shares
        new = shares * ((n / mix) @ p) / total
        done = np.abs(new - shares).max() < 1e-4
        shares = new
        if done:
            break
    return shares, float(n @ np.log(p @ shares))


def infer(grams: np.ndarray, logp: np.ndarray, p: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(languages, shares, posterior of each single language) of a document with at least one trigram."""
    n = np.bincount(grams, minlength=p.shape[0])
    at = np.flatnonzero(n)
    n = n[at].astype(np.float64)
    single = n @ logp[at]
    tempered = (single - single.max()) / OVERLAP
    posterior = np.exp(tempered) / np.exp(tempered).sum()
    own = p[at].astype(np.float64)
    chosen = [int(np.argmax(single))]
    shares, best = np.ones(1), float(single.max())
    need = penalty * np.log(max(n.sum(), 2.0)) / 2
    while len(chosen) < p.shape[1]:
        slope = ((n / (own[:, chosen] @ shares)) @ own) - n.sum()
        tries = []
        for lang in (x for x in range(p.shape[1]) if x not in chosen and slope[x] > 0):
            start = np.append(shares * 0.9, 0.1)
            got, ll = _fit(own[:, [*chosen, lang]], n, start)
            tries.append((ll, -lang, got))
        if not tries or (top := max(tries, key=lambda t: t[:2]))[0] - best <= need:
            break
        best, shares = top[0], top[2]
        chosen.append(-top[1])
    return chosen, shares, posterior


def known_share(grams: np.ndarray, p: np.ndarray) -> float:
    """Share of a document that the learned languages explain better than chance does: mixture shares over all
    languages and a background in which every trigram is equally likely."""
    n = np.bincount(grams, minlength=p.shape[0])
    at = np.flatnonzero(n)
    own = np.column_stack((p[at], np.full(len(at), 1 / p.shape[0])))
    shares, _ = _fit(own, n[at].astype(np.float64), np.full(own.shape[1], 1 / own.shape[1]))
    return float(1 - shares[-1])


def identify(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             penalty: float = PENALTY, bits: int = BITS) -> DataFrame:
    """One row per document: id, lang_pred, score, languages (array of lang, share; largest first)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    kind = docs.schema[id_col].dataType.simpleString()
    predict = _predictor(model, penalty, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = predict()
        for b in batches:
            got = [one(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                pa.array([g[2] for g in got], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                ["id", "lang_pred", "score", "languages"])

    out = rows.mapInArrow(tidy(run), f"id {kind}, lang_pred string, score double, "
                               "languages array<struct<lang:string,share:double>>")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score", "languages")


def _predictor(model: dict[str, np.ndarray], penalty: float, bits: int):
    names = sorted(model)
    p = np.stack([model[x] for x in names], axis=1) if names else np.zeros((1 << bits, 0), np.float32)

    def make():
        logp = np.log(p.astype(np.float64))

        def one(text: str | None):
            grams = trigrams(text, bits) if text and names else ()
            if not len(grams):
                return UND, 0.0, []
            chosen, shares, posterior = infer(grams, logp, p, penalty)
            order = sorted(range(len(chosen)), key=lambda i: (-shares[i], chosen[i]))
            top = order[0]
            score = shares[top] if len(chosen) > 1 else posterior[chosen[0]]
            return (names[chosen[top]], float(min(1.0, score)),
                [{"lang": names[chosen[i]], "share": float(shares[i])} for i in order])
        return one
    return make


def keep_identified(docs: DataFrame, model: dict[str, np.ndarray], min_share: float = 0.5, text_col: str = "text",
                    penalty: float = PENALTY, bits: int = BITS) -> DataFrame:
    """`docs` without the rejected documents: those without a letter and those in which no language
    reaches `min_share`. With an empty model every text with a letter stays."""
    predict, untaught = _predictor(model, penalty, bits), not model
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = predict()
        for b in batches:
            texts = b.column(at).to_pylist()
            if untaught:
                keep = [bool(t) and len(trigrams(t, bits)) > 0 for t in texts]
            else:
                keep = [bool(x) and x[0]["share"] >= min_share for x in (one(t)[2] for t in texts)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def keep_and_label(docs: DataFrame, model: dict[str, np.ndarray], lang_col: str = "lang", text_col: str = "text",
                   penalty: float = PENALTY, bits: int = BITS, min_known: float = MIN_KNOWN,
                   min_grams: int = MIN_GRAMS) -> DataFrame:
    """`docs` without the texts that are in no language; a missing language is filled with the predicted one.

    Rejected are texts without a letter and texts of which the learned languages explain less than `min_known`
    (`known_share`: unknown scripts, encoded data, keyboard noise), labelled or not. A text of fewer than `min_grams`
    trigrams shows too little to be rejected for that, and without a model there is nothing to hold texts against:
    those with a letter stay and nothing is filled. Labels that are there are kept."""
    predict = _predictor(model, penalty, bits)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = predict()
        p = np.stack([model[x] for x in sorted(model)], axis=1) if model else None

        def stays(text: str | None) -> bool:
            grams = trigrams(text, bits) if text else ()
            return len(grams) > 0 and (p is None or len(grams) < min_grams or known_share(grams, p) >= min_known)

        for b in batches:
            texts, langs = b.column(text_at).to_pylist(), b.column(lang_at).to_pylist()
            keep = [stays(t) for t in texts]
            filled = [one(t)[0] if k and lang is None and model else lang for t, lang, k in zip(texts, langs, keep)]
            columns = list(b.columns)
            columns[lang_at] = pa.array(filled, b.column(lang_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
