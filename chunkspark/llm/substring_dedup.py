"""Substring deduplication with a count-min prefilter.

Words are what lies between ASCII white space. A word goes when a window of
``LENGTH`` words that covers it also starts in a document with a smaller doc_id; windows are judged on
the input. Each task counts its windows in a count-min sketch of ``ROWS`` rows of
cells, under the key of the window's anchor, so equal windows count in the same
cells and the sketch never says less than a window's true count. The sketches of all
tasks are merged by sum; windows estimated at two or more go to the exact second pass
(``repeats.py``), which groups them by 128-bit fingerprints of all their words. The sketch's size is
fixed: on a corpus of more anchors than cells, more windows go to the second pass.

Null and empty texts have no words; texts shorter than a window stay whole. Rows with a null
doc_id stay whole. Rows repeated with the same doc_id are not smaller than each
other and stay. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from chunkspark.llm.common import documents, narrowed
from chunkspark.llm.repeats import Unit, anchor_filter, kept_bytes, removal, sha256
from chunkspark.plans.registry import query

LENGTH, GROUP = 50, 8
BITS, ROWS = 26, 2
SCHEMA = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def substring_dedup(docs: DataFrame, length: int = LENGTH, group: int = GROUP, doc_id: str = "doc_id", text: str = "text",
                    digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept text (its SHA-256 with ``digest``)."""
    unit = Unit(words=True, length=length, group=min(group, length), within=False)
    rows = narrowed(docs, doc_id, text)
    shared = anchor_filter(rows, unit, BITS, ROWS)

    def judge(part, gone, row):
        a, b = int(part.bounds[row]), int(part.bounds[row + 1])
        kept = kept_bytes(part, gone, row)
        return b - a, int(gone[a:b].sum()), sha256(kept).encode() if digest else kept

    return removal(rows, unit, shared, SCHEMA, "doc_id long, n_words long, n_removed long, kept binary", judge)


@query("op1_substring_dedup")
def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup(documents(spark, sf_dir), digest=True)
    return found.selectExpr("doc_id", "n_words", "n_removed", "cast(kept AS string) AS kept_sha256")
