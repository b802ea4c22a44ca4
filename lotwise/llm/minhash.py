"""MinHash near-duplicates by banding and sequential Bayesian verification.

Sets.  A text is the set of its distinct runs of ``SHINGLE`` words (lower-cased A-Z; a shorter text
as a whole; none: empty), each named by 64 bits of hash.  Equal sets are one node, so any
number of copies costs a count.  Two nodes link if 100 * |intersection| >= ``PERCENT`` * |union|.

Candidates.  ``HASHES`` smallest hashes a set, ``BANDS`` bands of ``ROWS``: a pair of similarity
0.85 misses all bands with probability (1 - 0.85**6)**40, about 6e-9.

Verification.  The lowest bytes of the smallest hashes are compared ``BATCH`` at a time.  After n of them with m
equal, a pair goes on only while the posterior probability (uniform prior) that its similarity reaches
the threshold is at least ``MISS``; survivors are verified exactly on their whole sets.

Groups.  Links are looked for in two steps, so that a group of copies is not compared pair by pair:

1. Every node is compared with the hub of each of its buckets, the member whose own buckets are the
   fullest (a text that many were copied from).  Confirmed links are joined into components.
2. Buckets whose members are one component are done.  In the others members of different components are
   compared, a pair in the first band it shares only.  A bucket is dealt into blocks of ``BLOCK`` members and each two blocks
   are a unit of work; survivors of a unit are verified in the unit, where a pair whose ends have been
   connected meanwhile is passed over, and leave as one row per node and neighbour in the
   unit's spanning tree.  No unit holds more than two blocks, whatever the bucket.

Only members of one bucket that stay unlinked are compared with all others of it; that is
inherent in an exact answer, and runs in blocks.

Defined results: a null or wordless text has an empty set and links with nothing; rows without an id get
a component but never name one, and a component without any id is null; repeated rows get the same
result each; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.base import components, landed, query, small_batches, table
from lotwise.llm.substrings import _bitmap, _grams, _has, _slices, word_hashes

SHINGLE, PERCENT = 3, 85
HASHES, ROWS, BANDS = 256, 6, 40
BATCH, MISS = 32, 1e-6
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
ID_BITS = 1 << 24
CHUNK = 512  # shingles hashed at a time
ODD = 0xC2B2AE3D27D4EB4F
FACTORS = np.random.default_rng(7).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the word runs of a text, given the hashes of its words."""
    n = len(hashes)
    return np.unique(_grams(hashes, SHINGLE, ODD) if n >= SHINGLE else _grams(hashes, max(n, 1), ODD ^ (n + 2)))


def signature(shingles: np.ndarray) -> bytes:
    """The lowest byte of the set's smallest value under every hash function."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), CHUNK):
        np.minimum(out, (shingles[i:i + CHUNK, None] * FACTORS).min(axis=0), out=out)
    return (_mixed(out) & np.uint64(255)).astype(np.uint8).tobytes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """Band number and bytes of every band, one long each."""
    bands = signatures[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.int64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.int64), bands.shape[:2])
    for i in range(ROWS):
        key = key << 8 | bands[:, :, i]
    return key


def least_equal(n: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """The fewest equal bytes of n at which the similarity may still reach the threshold.

    Bytes agree by chance too, so a similarity of s shows as s + (1 - s) / 256.  The posterior
    P(s' >= t | m of n) is P(Binomial(n + 1, t) <= m).
    """
    t = percent / 100 + (1 - percent / 100) / 256
    below = 0.0
    for m in range(n + 1):
        below += math.comb(n + 1, m) * t**m * (1 - t)**(n + 1 - m)
        if below >= miss:
            return m
    return n


LEAST_EQUAL = [(n, least_equal(n)) for n in range(BATCH, HASHES + 1, BATCH)]


def plausible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signatures (rows of bytes) pass every batch."""
    left, equal = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for n, least in LEAST_EQUAL:
        equal = equal + (a[left, n - BATCH:n] == b[left, n - BATCH:n]).sum(axis=1)
        left, equal = left[equal >= least], equal[equal >= least]
    out = np.zeros(len(a), dtype=bool)
    out[left] = True
    return out


def sizes_allow(m: np.ndarray, n: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(m, n) >= PERCENT * np.maximum(m, n)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows with the column ``text``, some at a time, and the shingle sets of their texts."""
    for b in batches:
        at = b.schema.get_field_index("text")
        for part, texts in _slices(b.column(at)):
            hashes, counts = word_hashes([(t or b"").lower() for t in texts])
            ends = np.cumsum(counts)
            yield b.slice(part.start, part.stop - part.start), [shingle_set(hashes[z - n:z]) for n, z in zip(counts, ends)]


def _name(shingles: np.ndarray) -> int:
    return int(_mixed(_mixed(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id, node, n, sig."""
    for b, sets in _sets(batches):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(_name, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(signature, sets), pa.binary())],
                                         names=["doc_id", "node", "n", "sig"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, sig) -> key, node, n: a row for every band."""
    for b in batches:
        if b.num_rows:
            at = np.repeat(np.arange(b.num_rows), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(_matrix(b.column("sig"))).ravel()), b.column("node").take(pa.array(at)), b.column("n").take(pa.array(at))],
                                             names=["key", "node", "n"])


def _plausible_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sig, other) -> a, b of the pairs that pass."""
    for b in batches:
        if b.num_rows:
            yield b.select(["a", "b"]).filter(pa.array(plausible(_matrix(b.column("sig")), _matrix(b.column("other")))))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by ``unit`` -> the rows of each unit."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        unit = b.column("unit").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            if held and held[0].column("unit")[0].as_py() != unit[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, band, across, half, node, n, comp, sig) by unit -> unit, node, comp, partners: the plausible pairs between
    components that share no earlier band, listed at one of their ends, and a row for every other end."""
    for t in _units(batches):
        node, n, comp, half = (t.column(c).to_numpy() for c in ("node", "n", "comp", "half"))
        band, across, sigs = t.column("band")[0].as_py(), t.column("across")[0].as_py(), _matrix(t.column("sig"))
        partners: dict[int, list[int]] = {}
        for i in range(len(node)):
            with_whom = np.flatnonzero((comp[i + 1:] != comp[i]) & ((half[i + 1:] != half[i]) | (not across)) & sizes_allow(n[i + 1:], n[i])) + i + 1
            if len(with_whom):
                with_whom = with_whom[plausible(np.broadcast_to(sigs[i], (len(with_whom), HASHES)), sigs[with_whom])]
                same = (sigs[with_whom, :band * ROWS] == sigs[i, :band * ROWS]).reshape(len(with_whom), band, ROWS).all(axis=2).any(axis=1)
                with_whom = with_whom[~same]
            if len(with_whom):
                partners.setdefault(i, []).extend(node[with_whom].tolist())
                for j in with_whom.tolist():
                    partners.setdefault(j, [])
        if partners:
            at = list(partners)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t.column("unit")[0].as_py(), dtype=np.int64)), pa.array(node[at]), pa.array(comp[at]),
                                              pa.array(partners.values(), pa.list_(pa.int64()))], names=["unit", "node", "comp", "partners"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact rule on two whole sets, each sorted."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _whole_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, s, t: their sets) -> a, b of the links."""
    for x in batches:
        if x.num_rows:
            sets = ([np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in x.column(c)] for c in ("s", "t"))
            yield x.select(["a", "b"]).filter(pa.array(map(linked, *sets), pa.bool_()))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, node, comp, partners, shingles) by unit -> a, b: links on whole sets that connect what the unit had not connected."""
    for t in _units(batches):
        sets = {x: np.frombuffer(s.as_buffer(), dtype=np.uint64) for x, s in zip(t.column("node").to_pylist(), t.column("shingles"))}
        comp = dict(zip(t.column("node").to_pylist(), t.column("comp").to_pylist()))
        parent = {c: c for c in comp.values()}

        def top(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        links = []
        for a, others in zip(t.column("node").to_pylist(), t.column("partners").to_pylist()):
            for b in others:
                if a in sets and b in sets and top(comp[a]) != top(comp[b]):
                    if linked(sets[a], sets[b]):
                        links.append((a, b))
                        parent[top(comp[a])] = top(comp[b])
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])


def _wanted_sets(bitmap):
    """(doc_id, text) -> node, shingles of the rows whose id is in the bitmap."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_has(bitmap.value, b.column("doc_id").fill_null(0).to_numpy())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(chosen(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(map(_name, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])
    return run


def _sets_of(docs: DataFrame, first: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the wanted nodes (and of some more), read again from one text each; first: node, least id."""
    ids = first.join(wanted, "node", "left_semi").select(F.coalesce("least", F.lit(0)).alias("least"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(ids, ID_BITS))
    rows = docs.mapInArrow(_wanted_sets(bitmap), "node long, shingles binary").join(wanted, "node", "left_semi")
    return landed(rows.dropDuplicates(["node"]), "sets")


def _hub_links(docs: DataFrame, nodes: DataFrame, first: DataFrame, members: DataFrame) -> DataFrame:
    """members (key, node, n, size, hub) -> a, b: confirmed links between nodes and hubs."""
    pairs = members.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), "sig")
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("other"))
    sized = pairs.join(a, "a").join(b, "b").where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    found = landed(sized.select("a", "b", "sig", "other").mapInArrow(_plausible_rows, "a long, b long"), "plausible")
    sets = _sets_of(docs, first, found.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    whole = (found.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a")
             .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b"))
    with small_batches(docs.sparkSession):
        return landed(whole.select("a", "b", "s", "t").mapInArrow(_whole_links, "a long, b long"), "links")


def _unit_links(docs: DataFrame, nodes: DataFrame, first: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    """Confirmed links between members of one bucket that are in different components (roots: node, root)."""
    known = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    hubs = known.where("node = hub").select("key", F.col("comp").alias("main"))
    known = known.join(hubs, "key").withColumn("out", F.col("comp") != F.col("main"))
    blocks = lambda side: F.ceil(F.greatest(F.sum(side.cast("int")) / BLOCK, F.sum(F.when(side, F.col("n"))) / BLOCK_SHINGLES)).cast("int")
    live = known.groupBy("key").agg(blocks(F.col("out")).alias("outer"), blocks(~F.col("out")).alias("inner")).where("outer > 0")
    own = F.when(F.col("out"), F.pmod(F.xxhash64("node"), F.col("outer"))).otherwise(F.pmod(F.xxhash64("node"), F.col("inner"))).cast("int")
    # one unit for a small bucket; else outsiders meet outsiders block by block, and insiders as numbers -1, -2, ...
    places = F.expr("""CASE
        WHEN outer = 1 AND inner = 1 THEN array(struct(0 AS i, 0 AS j, false AS across, 0 AS half))
        WHEN out THEN concat(
            transform(sequence(0, outer - 1), x -> struct(least(x, own) AS i, greatest(x, own) AS j, x != own AS across, CASE WHEN x < own THEN 1 ELSE 0 END AS half)),
            transform(sequence(0, inner - 1), x -> struct(own AS i, -1 - x AS j, true AS across, 0 AS half)))
        ELSE transform(sequence(0, outer - 1), x -> struct(x AS i, -1 - own AS j, true AS across, 1 AS half)) END""")
    units = (known.join(live, "key").withColumn("own", own).select("key", "node", "comp", F.explode(places).alias("p"))
             .select(F.xxhash64("key", "p.i", "p.j").alias("unit"), F.shiftrightunsigned("key", 8 * ROWS).cast("int").alias("band"), "p.across", "p.half", "node", "comp"))
    rows = units.join(nodes, "node").select("unit", "band", "across", "half", "node", "n", "comp", "sig")
    found = landed(rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(_candidates, "unit long, node long, comp long, partners array<bigint>"), "candidates")
    sets = _sets_of(docs, first, found.select("node").distinct())
    with small_batches(docs.sparkSession):
        return landed(found.join(sets, "node").select("unit", "node", "comp", "partners", "shingles")
                      .repartition("unit").sortWithinPartitions("unit").mapInArrow(_confirmed, "a long, b long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id, one row for each row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = landed(docs.mapInArrow(_described, "doc_id long, node long, n long, sig binary"), "signatures")
    named = described.where("n > 0")
    nodes = landed(named.select("node", "n", "sig").dropDuplicates(["node"]), "nodes")
    first = named.groupBy("node").agg(F.min("doc_id").alias("least"))

    keyed = nodes.mapInArrow(_keyed, "key long, node long, n long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = landed(keyed.join(shared, "key"), "members")
    fullness = members.groupBy("node").agg(F.sum("size").alias("fullness"))
    hubs = members.join(fullness, "node").groupBy("key").agg(F.max(F.struct("fullness", "node")).alias("h")).select("key", F.col("h.node").alias("hub"))
    members = landed(members.join(hubs, "key"), "members")

    roots = landed(components(_hub_links(docs, nodes, first, members)), "roots")
    more = _unit_links(docs, nodes, first, members, roots)
    roots = components(more.unionByName(roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))))

    known = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = known.join(smallest, "root").select("node", "component_id")
    alone = described.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return named.join(ids, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


@query("op12_minhash", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
j AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS common
      FROM g a JOIN g b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM j WHERE 100 * common >= 85 * (m + n - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE t(a, b) AS (SELECT a, b FROM e UNION SELECT t.a, e.b FROM t JOIN e ON t.b = e.a) SELECT a, min(b) AS least FROM t GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(r.least, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(r.least, doc_id)) AS kept
FROM s LEFT JOIN r ON r.a = doc_id""")
def op12_minhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
