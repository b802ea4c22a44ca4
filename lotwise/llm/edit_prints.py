"""Document fingerprints by a randomised edit embedding.

Embedding.  A text is walked character by character; at every output place a shared random
bit of (place, kind of character) says whether the walk goes on to the next character.  A
character so fills a run of places until its bit comes up, and two texts fall back into step
soon after an edit: edit distance becomes Hamming distance between the outputs.  The bits
repeat after ``PERIOD`` places, so the run of a character is one table look-up.

Fingerprint.  Every run (start place, character) of the whole text is hashed; the smallest
hash in each of ``CELLS`` cells is kept by its low byte.  The share of equal cells estimates
how much of the two outputs agrees (``likeness``).  Equal texts have equal fingerprints.

Near copies.  Each of ``BANDS`` bands takes the bytes of ``SAMPLED`` cells; distinct fingerprints with
equal bytes in a band, not all of them empty, meet in a bucket.  A pair at the limit (two thirds of the
cells equal) meets with a chance of 1 - (1 - (2/3)^5)^50 = 0.999, a closer one more surely.  In a bucket
a search goes from each fingerprint to all that are alike and not yet reached, on all cells: all
alike members of a bucket end up linked, be it through others, and a bucket of near copies of
one text costs its members once.  Buckets with the same members are searched once.  The query gives each
row the smallest id of its class (equal fingerprints and all that links join) and its fingerprint's links.

The edited text of a document needs the next one by descending id.  Rows are dealt to ranges
of ids between sampled quantiles and sorted there; the first row of a range is also sent to
the range before it, so every row has its successor at hand and no task sees all rows.  The
walk over the edited text continues that of the original from the place of the edit.

Defined results: a null text is an empty one; the empty text has the fingerprint of no run at all,
alike only to itself; a class of rows without ids has none; ids equal or null follow one another by text (null ids last); a single row
is its own successor; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import components, landed, query, table

PERIOD, KINDS, CELLS, SEED = 1 << 12, 64, 128, 5
EMPTY = 255  # byte of a cell no run fell into
BANDS, SAMPLED = 50, 5  # cells whose bytes a band samples
LIKE = 0.8
RANGES = 4  # ranges of ids per shuffle partition
STEP = 64  # splits compared at a time


@cache
def _steps() -> list[list[int]]:
    """For each kind of character and place: how many places its run fills (at most PERIOD)."""
    bits = np.random.default_rng(SEED).integers(0, 2, (KINDS, PERIOD), dtype=np.int8)
    bits[:, -1] = 1
    out = np.empty((KINDS, PERIOD), dtype=np.int64)
    wait = np.zeros(KINDS, dtype=np.int64)
    for place in range(PERIOD - 1, -1, -1):
        wait = np.where(bits[:, place] == 1, 1, wait + 1)
        out[:, place] = wait
    return out.tolist()


def walk(points: np.ndarray, start: int = 0) -> np.ndarray:
    """Start places of the runs of the characters, and last the place after them."""
    steps, mask = _steps(), PERIOD - 1
    place, out = start, [start]
    keep = out.append
    for kind in (points % KINDS).tolist():
        place += steps[kind][place & mask]
        keep(place)
    return np.array(out, dtype=np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowest(places: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The smallest hash of the runs in each cell; all ones where there is none."""
    out = np.full(CELLS, np.uint64(0xFFFFFFFFFFFFFFFF))
    if len(points):
        h = _mixed(places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + points.astype(np.uint64))
        np.minimum.at(out, (h & np.uint64(CELLS - 1)).astype(np.int64), h >> np.uint64(7))
    return out


def print_of(cells: np.ndarray) -> bytes:
    """One byte per cell, 255 where no run fell."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.where(cells == full, EMPTY, cells % np.uint64(EMPTY)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated share of runs that two outputs have in common; 1 for two empty texts.

    The share J of equal cells, among those that either has filled, is that of common runs among
    all runs of both; 2 J / (1 + J) is their share in one output, one less the Hamming distance.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    filled = (x != EMPTY) | (y != EMPTY)
    same = float((x == y)[filled].mean()) if filled.any() else 1.0
    return 2 * same / (1 + same)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4").astype(np.int64)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, extra, doc_id, text) sorted, each range closed by its extra rows -> one result per row that isn't extra."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out: list[tuple] = []
    last = None  # (range, id, text, code points, places, cells of the part an edit keeps, fingerprint)
    for b in batches:
        for at, extra, doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
            if extra and (last is None or last[0] != at):
                continue
            text = zlib.decompress(text).decode() if text else ""
            points = code_points(text)
            places = walk(points)
            keep = len(points) - len(points) // 3
            kept = lowest(places[:keep], points[:keep])
            own = print_of(np.minimum(kept, lowest(places[keep:-1], points[keep:])))
            if last is not None and last[0] == at:
                out.append(_edited(last, text, points, own))
            last = None if extra else (at, doc_id, text, points, places, kept, own)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def _edited(row: tuple, text: str, points: np.ndarray, following: bytes) -> tuple:
    """The result of a row, given its successor's text, code points and fingerprint."""
    _, doc_id, own_text, own_points, places, kept, own = row
    n, size = len(own_points), len(own_points) // 3
    put = points[:size]
    tail = walk(put, int(places[n - size]))
    edited = print_of(np.minimum(kept, lowest(tail[:-1], put)))
    digest = hashlib.sha256((own_text[:n - size] + text[:size]).encode()).hexdigest()
    return doc_id, n, digest, own.hex(), edited.hex(), likeness(own, edited), likeness(own, following)


def _range_of(splits: list[int]) -> Column:
    """Number of the range of doc_id, by falling ids: how many splits are larger; a null id is in the last one."""
    if not splits:
        return F.lit(0)
    def listed(values: list[int]) -> str:
        return "CAST(array(" + ", ".join(f"{s}L" for s in values) + ") AS array<bigint>)"

    blocks = f"size(filter({listed(splits[STEP - 1::STEP])}, s -> s <= doc_id)) * {STEP}"
    below = f"{blocks} + size(filter(slice({listed(splits)}, {blocks} + 1, {STEP}), s -> s <= doc_id))"
    return F.expr(f"CAST(IF(doc_id IS NULL, {len(splits)}, {len(splits)} - ({below})) AS int)")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the way to their range; null for none."""
    for b in batches:
        i = b.schema.get_field_index("text")
        texts = [zlib.compress(t) if t else None for t in b.column(i).cast(pa.binary()).to_pylist()]
        yield b.set_column(i, "text", pa.array(texts, pa.binary()))


def with_successors(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> (range, extra, doc_id, text: compressed) dealt and sorted so that each row's successor by falling id follows it."""
    spark = docs.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = sorted(set(docs.where("doc_id IS NOT NULL").select("doc_id").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))))
    docs = docs.withColumn("at", _range_of([int(x) for x in splits]))
    heads = sorted((r.at, r.top) for r in docs.select("doc_id", "at").groupBy("at").agg(F.max("doc_id").alias("top")).collect())
    top, sent_to = [None] * (len(splits) + 1), [None] * (len(splits) + 1)
    for i, (n, largest) in enumerate(heads):
        top[n], sent_to[n] = largest, heads[i - 1][0]
    first = F.col("doc_id").eqNullSafe(F.get(F.array(*[F.lit(x).cast("long") for x in top]), F.col("at")))
    before = F.when(first, F.get(F.array(*[F.lit(x).cast("int") for x in sent_to]), F.col("at")))
    places = F.expr("IF(before IS NULL, array(struct(at AS `range`, 0 AS extra)), array(struct(at AS `range`, 0 AS extra), struct(before AS `range`, 1 AS extra)))")
    tie = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    packed = (docs.select("doc_id", "text", "at", tie.alias("tie"), before.alias("before"))
              .mapInArrow(_packed, "doc_id long, text binary, at int, tie binary, before int"))
    return (packed.select(F.explode(places).alias("p"), "doc_id", "text", "tie").select("p.range", "p.extra", "doc_id", "text", "tie")
            .repartition("range").sortWithinPartitions("range", "extra", F.col("doc_id").desc_nulls_last(), "tie").drop("tie"))


def edit_prints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> fingerprints of each text and of its edited text, and their likeness."""
    rows = with_successors(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.mapInArrow(_results, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                     "near_edited double, near_next double")


def _bands() -> list[np.ndarray]:
    """Cells of the bands: pieces of random orders of all cells, so each cell is in some."""
    rng, out = np.random.default_rng(SEED), []
    while len(out) < BANDS:
        order = rng.permutation(CELLS)
        out += [np.sort(order[i:i + SAMPLED]) for i in range(0, CELLS - SAMPLED + 1, SAMPLED)]
    return out[:BANDS]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, fingerprint) -> (bucket, id), one for each band with a filled cell."""
    bands = _bands()
    for b in batches:
        ids = b.column(0).to_numpy()
        cells = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, CELLS)
        for n, band in enumerate(bands):
            part = cells[:, band].astype(np.uint64)
            there = (part != EMPTY).any(axis=1)
            bits = np.full(len(part), np.uint64(n))
            for i in range(SAMPLED):
                bits = bits << np.uint64(8) | part[:, i]
            yield pa.RecordBatch.from_arrays([pa.array(bits[there].view(np.int64)), pa.array(ids[there])], names=["bucket", "id"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Sorted rows (key, value) -> the values of each key that has several."""
    key, held = None, []
    for b in batches:
        for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if len(held) > 1:
                    yield held
                key, held = k, []
            held.append(v)
    if len(held) > 1:
        yield held


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, id) in order -> (members, id) of buckets with several ids; members names the set of ids."""
    names, out, seen = [], [], set()
    for ids in _groups(batches):
        name = hashlib.blake2b(np.array(ids, dtype=np.int64).tobytes(), digest_size=16).digest()
        if name not in seen:
            seen.add(name)
            names += [name] * len(ids)
            out += ids
        if len(out) >= 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.int64())], names=["members", "id"])
            names, out, seen = [], [], set()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.int64())], names=["members", "id"])


def _search(prints: list[str], like: float) -> Iterator[tuple[str, str, float]]:
    """Links (a, b, near) that join all alike fingerprints of a bucket."""
    cells = np.frombuffer(bytes.fromhex("".join(prints)), np.uint8).reshape(-1, CELLS)
    left, reached = np.arange(len(prints)), []
    while len(left):
        if reached:
            x = reached.pop()
        else:
            x, left = left[0], left[1:]
        filled = (cells[left] != EMPTY) | (cells[x] != EMPTY)
        same = ((cells[left] == cells[x]) & filled).sum(axis=1) / np.maximum(filled.sum(axis=1), 1)
        near = 2 * same / (1 + same)
        alike = near >= like
        for y, n in zip(left[alike].tolist(), near[alike].tolist()):
            yield min(prints[x], prints[y]), max(prints[x], prints[y]), n
            reached.append(y)
        left = left[~alike]


def _links(like: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        types = [pa.string(), pa.string(), pa.float64()]
        for prints in _groups(batches):
            for link in _search([p.hex() for p in prints], like):
                out.append(link)
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["a", "b", "near"])
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["a", "b", "near"])
    return run


def near_links(prints: DataFrame, like: float = LIKE) -> DataFrame:
    """prints (fingerprint) -> a, b, near: links between different fingerprints at least ``like`` alike.

    Fingerprints that are alike and share a band are linked, directly or through others; the
    links need not name all alike pairs of a large group.
    """
    named = prints.select("fingerprint").distinct().select(F.xxhash64("fingerprint").alias("id"), F.unhex("fingerprint").alias("fingerprint"))
    met = (named.mapInArrow(_keys, "bucket long, id long").repartition("bucket").sortWithinPartitions("bucket", "id")
           .mapInArrow(_met, "members binary, id long").distinct())
    return (met.join(named, "id").select("members", "fingerprint").repartition("members").sortWithinPartitions("members", "fingerprint")
            .mapInArrow(_links(like), "a string, b string, near double").distinct())


def _classes(rows: DataFrame) -> DataFrame:
    """rows (doc_id, fingerprint, ...), which must be landed -> print (hash of the fingerprint), near_class, n_links."""
    links = landed(near_links(rows), "near_links")
    both = links.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    degree = both.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    roots = components(both).join(degree, F.col("node") == F.col("id"), "left").select("node", "root", "n")
    known = (rows.groupBy(F.xxhash64("fingerprint").alias("print")).agg(F.min("doc_id").alias("own"))
             .join(roots, F.col("print") == F.col("node"), "left").withColumn("root", F.coalesce("root", "print")))
    least = known.groupBy("root").agg(F.min("own").alias("near_class"))
    return known.join(least, "root").select("print", "near_class", F.coalesce("n", F.lit(0)).alias("n_links"))


def with_classes(rows: DataFrame) -> DataFrame:
    """rows (doc_id, fingerprint, ...), which must be landed -> the same with near_class, the smallest id of the class, and n_links."""
    return rows.withColumn("print", F.xxhash64("fingerprint")).join(_classes(rows), "print").drop("print")


HEX = ["edited_sha256", "fingerprint", "edited_fingerprint"]


@query("op10_edit_prints")
def op10_edit_prints(spark, sf_dir: str) -> DataFrame:
    """Digests are written and joined as bytes and spelled out last."""
    spelled = {c: F.lower(F.hex(c)) for c in HEX}
    rows = landed(edit_prints(table(spark, sf_dir, "documents")).withColumns({c: F.unhex(c) for c in HEX}), "edit_prints")
    classes = _classes(rows.select("doc_id", spelled["fingerprint"].alias("fingerprint")))
    named = rows.withColumn("print", F.xxhash64(spelled["fingerprint"])).join(classes, "print").drop("print")
    return named.withColumns(spelled)
