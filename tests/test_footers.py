"""Footers: bytes as in the files, overlap of row groups, interleaved order."""

import os

import pytest
from pyspark.sql import functions as F

from cumulo.operators.layout import interleaved, layout_variants
from cumulo.sources import footers as FT


@pytest.fixture(scope="module")
def grid(spark):
    return spark.range(64 * 64).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"),
                                       F.when(F.col("id") % 10 != 0, F.col("id")).alias("n"))


def test_interleaved_order_on_a_grid(grid):
    got = {(r.x, r.y): r.z for r in grid.select("x", "y", interleaved(grid, ["x", "y"], bits=7).alias("z")).collect()}
    places = {v: int((v / 63) * 126) + 1 for v in range(64)}
    for (x, y), z in got.items():
        want = 0
        for i in range(7):
            want |= (places[x] >> i & 1) << (2 * i + 1) | (places[y] >> i & 1) << 2 * i
        assert z == want
    with pytest.raises(ValueError):
        interleaved(grid, ["x", "y"], bits=32)


def test_interleaved_of_nulls_and_single_values(spark):
    df = spark.createDataFrame([(None, 5), (3, 5), (9, 5)], "a int, b int")
    got = {r.a: r.z for r in df.select("a", interleaved(df, ["a", "b"], bits=4).alias("z")).collect()}
    assert got[None] < got[3] < got[9]


def test_bytes_and_rows_are_the_files(spark, grid):
    v = layout_variants(grid, {"plain": [], "sorted": ["x", "y"], "z": [interleaved(grid, ["x", "y"])]}, files=8)
    feet = FT.footers(v)
    sizes = {(r.variant, r.column): r for r in FT.column_sizes(feet).collect()}
    for name, df in v.items():
        total = sum(os.path.getsize(f.removeprefix("file:").replace("///", "/")) for f in df.inputFiles())
        data = sum(r.compressed_bytes for (var, _), r in sizes.items() if var == name)
        assert 0.3 * total < data < total  # the rest is the footer
        assert {r.num_rows for (var, _), r in sizes.items() if var == name} == {64 * 64}
        assert sizes[name, "n"].num_nulls == 410 and sizes[name, "x"].num_nulls == 0
    hit = {(r.variant, r.column): (r.row_groups, r.mean_hit) for r in FT.range_overlap(feet).collect()}
    assert hit["plain", "x"][1] == 1.0 and hit["sorted", "x"][1] < 0.3 and hit["sorted", "y"][1] > 0.9
    assert hit["z", "x"][1] < 0.7 and hit["z", "y"][1] < 0.7
    groups = feet.where("variant = 'z' AND column = 'x'").collect()
    brute = sum(sum(g.lo <= f.lo <= g.hi for g in groups) for f in groups) / len(groups) ** 2
    assert abs(brute - hit["z", "x"][1]) < 1e-9
