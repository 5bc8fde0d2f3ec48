"""Documents without a key are in op6's result too."""

import zlib
from collections import Counter

import numpy as np

from cumulo.llm import queries
from tests.llm.test_tokens import library_ids


def test_token_files_return_rows_without_a_key(spark_llm, scratch):
    rows = [(None, "the cat sat"), (None, ""), (None, None), (2**53 + 1, "on the mat"), (5, "one two"), (5, "one two")]
    spark_llm.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    got = queries.QUERIES["op6_token_files"](spark_llm, scratch).collect()
    crc = lambda t: zlib.crc32(np.array([*library_ids(t), 2], "<u4").tobytes())
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((i, crc(t or "")) for i, t in rows)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
