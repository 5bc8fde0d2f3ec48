"""Shard axes by rank against a plain tree, names that clash, letters of all planes, languages against plain Python."""

import math
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cumulo.llm import decontaminate, kd_shards, language_id
from tests.conftest import SF_MID, SF_SMALL


def _plain_tree(rows, n_dims, n):
    """shard of each row (weight, keys), split level by level like the operator says."""
    shard, todo = {}, [(0, n, list(range(len(rows))))]
    while todo:
        lo, m, some = todo.pop()
        if m == 1:
            shard.update({i: lo for i in some})
            continue
        width = [max(rows[i][1][d] >> kd_shards.TIE_BITS for i in some) - min(rows[i][1][d] >> kd_shards.TIE_BITS for i in some)
                 for d in range(n_dims)]
        axis = max(range(n_dims), key=lambda d: (width[d], -d))
        total = sum(rows[i][0] for i in some)
        want, upto, at = total * (m // 2) / m, 0, None
        by = Counter()
        for i in some:
            by[rows[i][1][axis]] += rows[i][0]
        for key in sorted(by):
            if upto + by[key] >= want:
                at = key + 1 if upto + by[key] - want <= want - upto else key
                break
            upto += by[key]
        todo += [(lo, m // 2, [i for i in some if rows[i][1][axis] < at]), (lo + m // 2, m - m // 2, [i for i in some if rows[i][1][axis] >= at])]
    return [shard[i] for i in range(len(rows))]


@pytest.mark.parametrize("n", [2, 7, 16])
def test_shards_are_those_of_a_plain_tree(spark_llm, n):
    docs = spark_llm.read.parquet(f"{SF_SMALL}/documents.parquet")
    dims = ["source", "lang", "n_chars", "doc_id"]
    meta = kd_shards._metadata(docs, "doc_id", "text", dims).withColumn("weight", F.col("bytes") + 1)
    got = kd_shards.split(kd_shards._keys(meta, len(dims)), len(dims), n).select("id", "weight", "keys", "lo").collect()
    assert [r.lo for r in got] == _plain_tree([(r.weight, r["keys"]) for r in got], len(dims), n)


def test_coordinates_are_ranks(spark_llm):
    values = ["https://example.com/a", "https://example.com/b", "https://example.com/c", "x"]
    rows = [(i, "t", values[i % 4] if i % 9 else None, 10**15 if i == 5 else i, float("nan") if i == 3 else i / 7) for i in range(200)]
    df = spark_llm.createDataFrame(rows, "doc_id long, text string, source string, n long, x double").repartition(3)
    meta = kd_shards._metadata(df, "doc_id", "text", ["source", "n", "x"]).collect()
    by = {r.id: r for r in meta}
    top = (1 << kd_shards.COORD_BITS) - 1
    rank = lambda j, m: math.floor(j * (top - 1) / (m - 1)) + 1
    assert {by[i].c0 for i in range(200) if i % 9 == 0} == {0} and by[3].c2 == 0
    assert [by[i].c0 for i in (4, 1, 2, 3)] == [rank(j, 4) for j in range(4)]
    order = sorted(range(200), key=lambda i: 10**15 if i == 5 else i)
    assert [by[i].c1 for i in order] == [rank(j, 200) for j in range(200)]
    # sources that share a long prefix are split along the source, one outlying number does not hide the rest
    shards = {r.doc_id: r.shard for r in kd_shards.kd_shards(df.where("source IS NOT NULL"), ["source"], n_shards=4).collect()}
    for s in range(4):
        assert len({values[i % 4] for i, k in shards.items() if k == s}) <= 2
    halves = {r.doc_id: r.shard for r in kd_shards.kd_shards(df, ["n"], n_shards=2).collect()}
    cut = max((i for i in order if halves[i] == 0), key=order.index)
    assert all(halves[i] == 0 for i in order[:order.index(cut) + 1])


def test_contaminated_filter_with_clashing_names(spark_llm):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    items = spark_llm.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark_llm.createDataFrame([(1, item, 0, "r"), (2, "clean text of five words", 1, "s"), (None, item, 2, "t")],
                                     "doc_id long, text string, _bad int, _row string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "clean text of five words", 1, "s")]
    for limits in ({"broadcast_bytes": 0}, {"broadcast_rows": 0}):
        assert decontaminate.contaminated_pairs(docs, items, **limits).count() == 2


def test_letters_of_all_planes(spark_llm):
    texts = [(1, chr(0x32100) * 9), (2, "\U0001F600 12"), (3, "\U00010400"), (4, "ª"), (5, "\U000E0041")]
    docs = spark_llm.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.learn(docs)).collect()}
    assert got == {i: "en" if any(c.isalpha() for c in t) else "und" for i, t in texts}


def test_too_many_languages(spark_llm):
    docs = spark_llm.createDataFrame([(f"text number {i}", f"l{i}") for i in range(6)], "text string, lang string")
    assert len(language_id.learn(docs, max_langs=6)) == 6
    with pytest.raises(ValueError):
        language_id.learn(docs, max_langs=5)


def _plain_model(rows, bits):
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(language_id.trigrams(text, bits).tolist())
    return {x: {g: (c[g] + 0.5) / (sum(c.values()) + 0.5 * 2**bits) for g in range(2**bits)} for x, c in counts.items()}


def _plain_shares(grams, model, langs):
    shares = {x: 1 / len(langs) for x in langs}
    for _ in range(400):
        new = dict.fromkeys(langs, 0.0)
        for g, n in grams.items():
            mix = sum(shares[x] * model[x][g] for x in langs)
            for x in langs:
                new[x] += n * shares[x] * model[x][g] / mix
        shares = {x: v / sum(grams.values()) for x, v in new.items()}
    return shares, sum(n * math.log(sum(shares[x] * model[x][g] for x in langs)) for g, n in grams.items())


def test_languages_against_plain_python(spark_llm):
    """Sets grown by the largest gain in likelihood under the penalty, shares by plain EM."""
    t = pq.read_table(f"{SF_MID}/documents.parquet").to_pandas()
    t = t[t.text.str.len().between(300, 900)]
    train = [(r.text, r.lang) for r in t.head(120).itertuples()]
    some = {lang: g.text.tolist() for lang, g in t.tail(200).groupby("lang")}
    tests = [x[0] for x in some.values()] + [x[1][:60] for x in some.values()]
    names = sorted(some)
    tests += [some[names[0]][2][:300] + " " + some[names[1]][2][:300], some[names[2]][2][:400] + " " + some[names[0]][3][:200]]
    bits = 11
    model = _plain_model(train, bits)
    df = spark_llm.createDataFrame(train, "text string, lang string")
    docs = spark_llm.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.learn(df, bits=bits), bits=bits).collect()}
    for i, text in enumerate(tests):
        grams = Counter(language_id.trigrams(text, bits).tolist())
        fits = {x: _plain_shares(grams, model, [x])[1] for x in model}
        chosen = [max(sorted(fits), key=fits.get)]
        shares, ll = _plain_shares(grams, model, chosen)
        need = language_id.PENALTY * math.log(sum(grams.values())) / 2
        while len(chosen) < len(model):
            tried = {x: _plain_shares(grams, model, [*chosen, x]) for x in model if x not in chosen}
            best = max(sorted(tried), key=lambda x: tried[x][1])
            if tried[best][1] - ll <= need:
                break
            chosen.append(best)
            shares, ll = tried[best]
        assert {x.lang for x in got[i].languages} == set(chosen), i
        for x in got[i].languages:
            assert abs(x.share - shares[x.lang]) < 0.02
        assert got[i].lang_pred == max(sorted(shares), key=shares.get)


def test_language_stage_fills_what_is_missing(spark_llm):
    docs = spark_llm.read.parquet(f"{SF_MID}/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 5 != 0, F.col("lang")))
    kept = corpus_pipeline.STAGES[0][1](spark_llm, hidden, SF_MID)
    assert kept.schema == hidden.schema
    true = {r.doc_id: r.lang for r in docs.collect()}
    filled = kept.collect()
    assert all(r.lang == true[r.doc_id] for r in filled if r.doc_id % 5)
    guessed = [r for r in filled if r.doc_id % 5 == 0]
    assert sum(r.lang == true[r.doc_id] for r in guessed) / len(guessed) > 0.97
