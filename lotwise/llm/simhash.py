"""SimHash near-duplicates found by pigeonring filtering.

Fingerprints.  Words are lower-cased (A-Z) and split at white space; every run of three
words (repeats included; a shorter text as a whole) is hashed, and a bit of the
fingerprint is set if it is set in over half of the hashes.

Pigeonring.  The 64 bits are four segments in a ring.  If two fingerprints differ in at most
3 bits, some segment starts a chain whose first l segments together differ in at most
floor(l * 3 / 4) bits for every l: 0, then 1, then 2, then 3.  So fingerprints meet on (start,
first segment, second segment), the second one also with each single bit flipped: 32 key
bits instead of the 16 of plain pigeonholes.  The third sum and the full distance are
checked on the pair.

Size.  Equal fingerprints are one node: only distinct ones are joined, so thousands of copies
cost a count, and the pairs made are the links between different fingerprints plus the few
candidates that share 32 bits by chance.  Components of the links come from alternating stars.

Defined results: a null or wordless text has fingerprint 0 and links like any other;
repeated rows get the same result each; rows without an id get a component but never name
one, and a component without any id is null; an empty table gives no rows; columns of the
input other than id and text play no part and are kept by ``near_duplicates``, whatever they
are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import components, landed, query, sheltered, small_batches, table

SEGMENTS, WIDTH, LIMIT = 4, 16, 3
SHINGLE = 3
PIECE = 1 << 16  # hashes whose bits are counted at a time


def fingerprint(text: bytes | None) -> int:
    """The 64-bit fingerprint, unsigned."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(words, words[1:], words[2:])), repeat(42))
    values = np.fromiter(hashes, dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(values), PIECE):
        part = values[i:i + PIECE].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values)).tobytes(), "big")


def _prints(text: str, drop: bool):
    """The rows with the fingerprint of a column's texts, which is left out if ``drop``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.schema.get_field_index(text)
            texts = b.column(i).cast(pa.binary()).to_pylist()
            fps = np.fromiter(map(fingerprint, texts), dtype=np.uint64, count=b.num_rows).view(np.int64)
            rest = [j for j in range(b.num_columns) if not (drop and j == i)]
            yield pa.RecordBatch.from_arrays([*(b.column(j) for j in rest), pa.array(fps)], names=[*(b.schema.names[j] for j in rest), "fingerprint"])
    return run


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``fingerprint`` (the 64 bits as a long)."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    types = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "_text")
    return rows.mapInArrow(_prints("_text", drop=True), types + ", fingerprint long")


def _segment(i: int) -> str:
    return f"(shiftrightunsigned(fp, {(SEGMENTS - 1 - i % SEGMENTS) * WIDTH}) & 65535)"


def pairs(prints: DataFrame) -> DataFrame:
    """prints (fp: distinct longs) -> a, b: all pairs a < b that differ in 1 to 3 bits, each once."""
    key = "(CAST({i} AS bigint) << 32) | ({first} << 16) | {second}"
    own = ", ".join(key.format(i=i, first=_segment(i), second=_segment(i + 1)) for i in range(SEGMENTS))
    near = ", ".join("transform(flips, m -> " + key.format(i=i, first=_segment(i), second=f"({_segment(i + 1)} ^ m)") + ")" for i in range(SEGMENTS))
    flips = "array(0L, " + ", ".join(f"{1 << b}L" for b in range(WIDTH)) + ")"
    index = prints.select(F.col("fp").alias("b"), F.explode(F.expr(f"array({own})")).alias("key"))
    probes = prints.withColumn("flips", F.expr(flips)).select(F.col("fp").alias("a"), F.explode(F.expr(f"flatten(array({near}))")).alias("key"))
    found = probes.join(index, "key").where("a < b").withColumn("x", F.expr("a ^ b"))
    start = "CAST(key >> 32 AS int)"
    third = f"bit_count(shiftrightunsigned(x, ({SEGMENTS - 1} - ({start} + 2) % {SEGMENTS}) * {WIDTH}) & 65535)"
    second = f"bit_count(shiftrightunsigned(x, ({SEGMENTS - 1} - ({start} + 1) % {SEGMENTS}) * {WIDTH}) & 65535)"
    return (found.where(f"{second} + {third} <= {2 * LIMIT // SEGMENTS + 1}").where(f"bit_count(x) <= {LIMIT}")
            .select("a", "b").distinct())


def groups(prints: DataFrame) -> DataFrame:
    """prints (fingerprint) -> fp, root: the linked fingerprints only; equal root, same group."""
    nodes = prints.select(F.col("fingerprint").alias("fp")).distinct()
    linked = components(pairs(nodes))
    return linked.select(F.col("node").alias("fp"), "root")


def labelled(prints: DataFrame) -> DataFrame:
    """prints (doc_id, fingerprint, ...) -> the same rows with component_id, the smallest id reachable."""
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("own"))
    linked = groups(prints)
    known = least.join(linked, least.fingerprint == linked.fp, "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = known.groupBy("root").agg(F.min("own").alias("component_id"))
    ids = known.join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs, one row of each group: that of the smallest id (of equal ones any one, always the same in a written table)."""
    rows, inner, names = sheltered(docs)
    types = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    with small_batches(docs.sparkSession):
        kept = landed(rows.mapInArrow(_prints(inner["text"], drop=False), types + ", fingerprint long"), "documents")
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")]
    doc_id = F.col(inner["doc_id"])
    who = kept.select("fingerprint", F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), *place).alias("who"))
    first = who.groupBy("fingerprint").agg(F.min("who").alias("who"))
    linked = groups(kept)
    chosen = (first.join(linked, F.col("fingerprint") == F.col("fp"), "left")
              .groupBy(F.coalesce("root", "fingerprint")).agg(F.min("who").alias("who")).select("who._file", "who._at"))
    return kept.select(*rows.columns, *place).join(chosen, ["_file", "_at"], "left_semi").select(*names)


@query("op3_simhash")
def op3_simhash(spark, sf_dir: str) -> DataFrame:
    prints = landed(fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    return labelled(prints).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
