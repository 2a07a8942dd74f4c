"""Fill-in-the-middle texts by SQL on Arrow batches.

Each batch is registered in a DuckDB of its task, which cuts lines, draws the
places and writes the texts in one statement and gives Arrow back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import BATCH_BYTES, documents, task

#: Memory of a task's DuckDB; a batch of texts is BATCH_BYTES, or one longer text.
MEMORY = "1GB"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string, output_sha256 string, restored_sha256 string"

DRAW = """
    WITH lines AS (
        SELECT row, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS line,
               sha256($seed || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash
        FROM batch),
    drawn AS (
        SELECT row, doc_id, text, line, len(line) AS n,
               CAST('0x' || hash[1:8] AS UBIGINT) % (len(line) + 1) AS x, CAST('0x' || hash[9:16] AS UBIGINT) % (len(line) + 1) AS y,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR CAST('0x' || hash[17:24] AS UBIGINT) % 100 >= $share THEN 'plain'
                    WHEN CAST('0x' || hash[25:32] AS UBIGINT) % 100 < $spm THEN 'spm' ELSE 'psm' END AS form
        FROM lines),
    cut AS (
        SELECT row, doc_id, text, n, form,
               coalesce(array_to_string(list_slice(line, 1, least(x, y)), ''), '') AS prefix,
               coalesce(array_to_string(list_slice(line, least(x, y) + 1, greatest(x, y)), ''), '') AS middle,
               coalesce(array_to_string(list_slice(line, greatest(x, y) + 1, n), ''), '') AS suffix
        FROM drawn),
    made AS (
        SELECT row, doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                         WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END AS output
        FROM cut)"""

#: The text out of output and form alone: no mark stands in a text that is cut, so a mark's first place is its own.
RESTORE = """
    parts AS (SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM made),
    back AS (
        SELECT *, CASE form WHEN 'psm' THEN substring(output, 4, s - 4) || substring(output, m + 3) || substring(output, s + 3, m - s - 3)
                            WHEN 'spm' THEN substring(output, p + 3, m - p - 3) || substring(output, m + 3) || substring(output, 4, p - 4)
                            ELSE output END AS restored
        FROM parts)"""

STATEMENT = f"""{DRAW},{RESTORE}
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(prefix_chars AS BIGINT) AS prefix_chars, CAST(middle_chars AS BIGINT) AS middle_chars,
           output, restored, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256
    FROM back ORDER BY row"""


def fill_in_middle(docs: DataFrame, seed: int = 7, share: int = 100, spm: int = 50) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n, form, prefix_chars, middle_chars, output, restored and both texts' digests.

    Lines (with their ends) are the units; prefix, middle and suffix end after numbers of lines that sha256 of seed and doc_id draws.
    form is `plain` (output is the text), `psm` or `spm`; `share` percent of texts are cut, `spm` percent of those as spm. Empty texts and those that hold a mark are plain.
    restored is rebuilt from output and form. Null counts as the empty text; a null doc_id draws as an empty one does. Rows that repeat a doc_id are cut each, at
    numbers from one draw. Texts of any length are cut whole. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""}) as con:
            for batch in batches:
                for part in _parts(batch):
                    con.register("batch", part)
                    yield from con.sql(STATEMENT, params={"seed": str(seed), "share": share, "spm": spm}).to_arrow_table().cast(_ARROW).combine_chunks().to_batches()
                    con.unregister("batch")

    return documents(docs).mapInArrow(task(run), SCHEMA)


_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (c.split() for c in SCHEMA.split(", "))])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Runs of rows of about BATCH_BYTES, a row at least, with each row's place."""
    a = 0
    while a < batch.num_rows:
        b = batch.num_rows
        while b > a + 1 and batch.slice(a, b - a).get_total_buffer_size() > BATCH_BYTES and batch.slice(a, b - a).nbytes > BATCH_BYTES:
            b = a + max(1, (b - a) // 2)
        part = pa.Table.from_batches([batch.slice(a, b - a)])
        yield part.append_column("row", pa.array(range(part.num_rows), pa.int64()))
        a = b


def middle_digests(docs: DataFrame) -> DataFrame:
    """fill_in_middle() without its texts."""
    return fill_in_middle(docs).drop("output", "restored")
