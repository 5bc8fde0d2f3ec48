"""Exact dedup, near dedup, substring dedup and decontamination."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cumulo.llm import decontaminate, exact_dedup, near_dedup, queries, substring_dedup
from cumulo.llm.common import words
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import TRICKY


def _documents():
    t = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pandas()
    return sorted(zip(t.doc_id, t.text))


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda c: F.char_length(c).cast("string"),
                                    lambda c: F.lit("same")])
def test_exact_groups_on_tricky_rows(tricky, digest):
    got = exact_dedup.exact_groups(tricky, digest=digest, salts=2)
    groups = {}
    for i, t, _ in TRICKY:
        groups.setdefault(brute.lower(t), []).append(i)
    want = []
    for i, t, _ in TRICKY:
        g = groups[brute.lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep))
    assert _rows(got, "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)
    left = exact_dedup.drop_copies(tricky, digest=digest, salts=2)
    assert left.columns == tricky.columns
    assert _rows(left, "doc_id") == sorted({(x[1],) for x in want} | set(), key=repr)


def test_exact_on_empty(empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_copies(empty).columns == empty.columns
    assert exact_dedup.drop_copies(empty).count() == 0


def test_near_copies_match_brute_force(spark_llm):
    got = queries.QUERIES["op8_near_dedup"](spark_llm, SF_SMALL).collect()
    docs = _documents()
    want = brute.components(docs, 4, 80)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(brute.shingles(t, 4)) for i, t in docs}
    assert all(r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_near_copies_in_chains_and_large_groups(spark_llm):
    """Copies that resemble only their neighbours, a star around one text, and many mutual near copies."""
    rnd = random.Random(4)
    fresh = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    rows, base = [], fresh(120)
    for _ in range(12):  # a chain: a few words move on at each step
        rows.append(" ".join(base))
        base = base[4:] + fresh(4)
    hub = fresh(150)
    for _ in range(60):  # a star: each far enough from the others
        x = list(hub)
        for _ in range(3):
            x[rnd.randrange(150)] = fresh(1)[0]
        rows.append(" ".join(x))
    rows.append(" ".join(hub))
    rows += [" ".join(fresh(80)) for _ in range(20)]
    order = list(range(len(rows)))
    rnd.shuffle(order)
    data = [(i, rows[j]) for i, j in enumerate(order)]
    got = near_dedup.near_copies(spark_llm.createDataFrame(data, "doc_id long, text string"), k=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == brute.components(data, 4, 80)


def test_near_copies_on_tricky_rows(tricky, empty):
    got = near_dedup.near_copies(tricky, k=4)
    have = {}
    for r in got.collect():
        have.setdefault(r.doc_id, set()).add((r.component_id, r.kept))
    assert have[1] == have[1] and have[2] == {(1, False)} and have[1] == {(1, True)}
    assert have[3] == {(3, True)} and have[4] == {(4, True)} and have[5] == {(5, True)}  # blank: linked with nothing
    assert have[-5] == {(-5, True)} and have[6] == have[7] == {(-5, False)}
    assert have[None] == {(None, True)}
    assert have[13] == {(10, False)}
    assert got.count() == len(TRICKY)
    left = near_dedup.drop_near_copies(tricky, k=4)
    assert left.columns == tricky.columns
    ids = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    assert ids == [-5, 1, 3, 4, 5, 8, 9, 10, 11, 12, 14] or ids == [-5, 1, 3, 4, 5, 8, 9, 10, 11, 14]
    assert left.where("doc_id IS NULL").count() == 2
    assert near_dedup.near_copies(empty).count() == 0
    assert near_dedup.drop_near_copies(empty).count() == 0


def test_repeated_row_stays_once(spark_llm):
    df = spark_llm.createDataFrame([(7, "a b c d e f g")] * 3 + [(8, "a b c d e f g")], "doc_id long, text string")
    assert _rows(near_dedup.drop_near_copies(df), "doc_id") == [(7,)]
    assert _rows(exact_dedup.drop_copies(df), "doc_id") == [(8,)]
    df = spark_llm.createDataFrame([(7, "a b c d e f g")] * 3, "doc_id long, text string")
    assert _rows(exact_dedup.drop_copies(df), "doc_id") == [(7,)]


def test_posterior_bounds():
    """The least number of matches falls short of the miss probability, and one more does not."""
    for n, m in near_dedup.least_matches(0.8, 1e-7):
        assert 0 < m < 0.8 * n


@pytest.mark.parametrize("group", [20_000, 3])
def test_substring_dedup_matches_brute_force(spark_llm, group):
    docs = _documents()
    df = spark_llm.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring_dedup.remove_repeats(df, group=group).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("d")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.d) for r in got} == brute.without_repeats(docs, 20)


@pytest.mark.parametrize("group", [20_000, 2])
def test_substring_dedup_overlaps_and_self_repeats(spark_llm, group):
    rnd = random.Random(1)
    long = [f"w{rnd.randrange(50)}" for _ in range(300)]
    docs = [(i, " ".join(long[a:a + 60])) for i, a in enumerate(rnd.choices(range(240), k=40))]
    docs += [(50, " ".join(["x"] * 90)), (51, " ".join(["x"] * 45)), (52, " ".join(["p", "q"] * 40)), (53, None), (54, ""),
             (55, " ".join(long[:19])), (56, " ".join(long[:20]))]
    df = spark_llm.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = substring_dedup.remove_repeats(df, group=group)
    have = {r.doc_id: (r.n_words, r.n_removed, r.d) for r in got.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("d")).collect()}
    assert have == brute.without_repeats(docs, 20)
    for r in got.collect():
        assert sum(s.after - s.first for s in r.spans) == r.n_removed


def test_substring_dedup_on_tricky_rows(tricky, empty):
    got = substring_dedup.remove_repeats(tricky, length=20).collect()
    assert len(got) == len(TRICKY)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert (by[3].n_words, by[3].n_removed, by[3].kept_text) == (0, 0, "")
    assert by[10].n_words == 9000 and by[10].n_removed == 9000 - 700 - 0
    assert by[13].n_removed == 9000 and by[13].kept_text == "end"
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_contaminated_pairs_by_hand(spark_llm, tricky, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"  # 8 shingles
    items = spark_llm.createDataFrame([(1, item), (2, "one two"), (3, None), (4, ""), (5, item.upper())],
                                      "item_id long, text string")
    pad = " ".join(f"p{i}" for i in range(3000))
    docs = spark_llm.createDataFrame([
        (1, f"{pad} {item} {pad}", 0), (2, f"{pad} {item.replace('mu', 'nu')}", 0),  # 7 of 8
        (3, item.replace("alpha", "a").replace("mu", "nu"), 0),  # 6 of 8: too few
        (4, "One Two", 0), (5, "one two three", 0), (6, None, 0), (7, "", 0), (None, item, 0), (8, item, 0), (8, item, 0)],
        "doc_id long, text string, item long")
    for limit in (decontaminate.BROADCAST_ROWS, 0):
        got = decontaminate.contaminated_pairs(docs, items, broadcast_rows=limit)
        assert _rows(got, "doc_id", "item_id", "n_item", "n_shared") == sorted(
            [(d, q, 8, n) for d, n in ((1, 8), (2, 7), (None, 8), (8, 8)) for q in (1, 5)] + [(4, 2, 1, 1)], key=repr)
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and _rows(left, "doc_id") == [(3,), (5,), (6,), (7,)]
    assert decontaminate.contaminated_pairs(empty, items).count() == 0
    assert decontaminate.drop_contaminated(tricky, items.where("false")).count() == len(TRICKY)


def test_containment_search_misses_nothing(spark_llm):
    """Against brute force, with items of all sizes and documents around the threshold."""
    rnd = random.Random(9)
    items = [(i, " ".join(f"v{rnd.randrange(3000)}" for _ in range(rnd.randint(1, 60)))) for i in range(60)]
    docs = []
    for d in range(240):
        w = rnd.choice(items)[1].split()
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = "other"
        docs.append((d, " ".join([f"v{rnd.randrange(3000)}" for _ in range(rnd.randint(0, 200))] + w)))
    got = decontaminate.contaminated_pairs(spark_llm.createDataFrame(docs, "doc_id long, text string"),
                                           spark_llm.createDataFrame(items, "item_id long, text string"))
    sets = {i: brute.shingles(t, 5) for i, t in items}
    want = [(d, i) for d, t in docs for s in [brute.shingles(t, 5)] for i, q in sets.items() if 100 * len(q & s) >= 80 * len(q)]
    assert _rows(got, "doc_id", "item_id") == sorted(want, key=repr)


def test_native_plans_run_no_python(spark_llm):
    for name in ("op1_decontaminate", "op9_chat_format", "op10_exact_dedup"):
        plan = queries.QUERIES[name](spark_llm, SF_SMALL)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name


def test_words_split_on_ascii_breaks_only(spark_llm):
    df = spark_llm.createDataFrame([("  a b\tc\x0b\x1cd  ",), (None,), ("",)], "t string")
    assert [r.w for r in df.select(words(F.col("t")).alias("w")).collect()] == [["a b", "c", "\x1cd"], [], []]


@pytest.mark.parametrize("small,block", [(24, 512), (3, 20)])
def test_template_just_below_the_threshold(spark_llm, monkeypatch, small, block):
    """Texts of one template, most pairs a little below 0.8 and some above: no pair becomes a row, no link is lost."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rnd = random.Random(12)
    base, data = [f"t{i}" for i in range(160)], []
    for i in range(220):
        w = list(base)
        for p in rnd.sample(range(160), rnd.choice([5, 5, 5, 4, 3])):
            w[p] = rnd.choice(["p", "q"])
        data.append((i, " ".join(w)))
    want = brute.components(data, 4, 80)
    assert 20 < len(set(want.values())) < 215
    got = near_dedup.near_copies(spark_llm.createDataFrame(data, "doc_id long, text string").repartition(3), k=4).collect()
    assert {r.doc_id: r.component_id for r in got} == want
