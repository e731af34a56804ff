"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words (lower case, between ASCII white space); a text of fewer words is one
shingle. A shingle weighs (occurrences in the text) * (1 + 0.1 * log(N / df) / log(N)), with N and df counted
over all documents. The part of df is kept small: a copy's changed shingles are rare and its
others are not, so a larger one would push copies that share 0.8 of their shingles under 0.8. Two texts are linked when the sum of the lesser weights is at least 0.8 of the sum of the
greater ones (weighted Jaccard), which is checked exactly. Classes are the components of the links.

Candidates: every text gets 64 consistent weighted samples, each of which two texts share with a
probability of their similarity, in 16 bands of 4. Within a band's bucket the text with most bucket
mates is compared with all others, so a bucket of n texts gives n - 1 pairs. Texts of buckets that
hold several classes after that are put into buckets by two bands at a time, where texts that
share no more than a passage hardly meet, and again the foremost text is compared with all
others. What then still shares such buckets between classes is compared in blocks, all with all, in
tasks that give only the links they need; nothing is cut off. Two texts at a similarity of 0.8 share a band in
99.98 % and two bands in 99.7 %, at 0.85 in 99.99 %.
Pairs that agree in fewer than 38 of the 64 samples cannot be links (at a similarity of 0.8, that is
more than four standard deviations off) and skip the exact check.

Copies of one text are put together first. Texts without words are linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm import sorted_hash as H
from asfalto.llm.batches import free_name, split_words, text_parts, texts_of
from asfalto.llm.components import components
from asfalto.operators.layout import stage
from asfalto.session import new_folder

WORDS = 5
SIMILARITY = 0.8
IDF_SHARE = 0.1
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
LEAST_AGREEING = 38
BLOCK_TEXTS = 256
SHARD_BYTES = 24 << 20
_U = np.uint64
_STEPS = [_U(2 * s + 1) for s in (0x4F1BBCDC, 0x9E3779B97F4A7C15 >> 1, 0x2545F491, 0x6A09E667F3BCC909 >> 1, 0x3C6EF372)]


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hashes, times each occurs in its text, offsets)."""
    places, dictionary, offsets = split_words(pc.ascii_lower(texts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, dictionary.to_pylist()), np.uint64, len(dictionary))
    own = hashes[places]
    counts = np.diff(offsets)
    runs = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    starts = np.cumsum(runs) - runs
    owner = np.repeat(np.arange(len(runs)), runs)
    at = np.arange(len(owner)) - starts[owner] + offsets[owner]
    padded = np.concatenate([own, np.zeros(words, np.uint64)])
    mixed = np.zeros(len(owner), np.uint64)
    length = counts[owner]
    short = np.flatnonzero(length < words)
    for k in range(words):
        word = padded[at + k]
        if len(short):
            word[short[length[short] <= k]] = 0
        mixed += word * _STEPS[k % len(_STEPS)]
        mixed = H.mix(mixed) if k % 2 else mixed
    mixed = H.mix(mixed)
    order = np.argsort(mixed)
    # owners of a part are few, so this second, stable sort is a radix sort
    order = order[np.argsort(owner[order].astype(np.uint16 if len(runs) < 1 << 16 else np.int64), kind="stable")]
    mixed, owner = mixed[order], owner[order]
    if not len(mixed):
        return mixed, np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.flatnonzero(
        np.concatenate([[True], (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])])
    )
    times = np.diff(np.append(first, len(mixed)))
    found = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(runs)))])
    return mixed[first], times, found


@dataclass(frozen=True)
class Frequencies:
    """Number of documents, and where shingles of two documents or more have theirs."""

    folder: str
    shards: int
    documents: int

    def weights(self, hashes: np.ndarray, times: np.ndarray) -> np.ndarray:
        (_, df) = H.opened(self.folder, self.shards).find(hashes, "df")
        n = max(2, self.documents)
        return times * (1 + IDF_SHARE * np.log(n / np.maximum(1, df)) / np.log(n))


def frequencies(docs: DataFrame, words: int = WORDS, shard_bytes: int = SHARD_BYTES) -> Frequencies:
    """Count in how many documents each shingle occurs; those of one document need no entry."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").alias("text"))
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    shards = max(1, -(-(size or 0) // shard_bytes))
    folder = new_folder(spark, "shingles")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = H.Counter("df", shards)
        for part in text_parts(batches):
            yield from counter.add(shingles(texts_of(part), words)[0])
        yield from counter.flush()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, packed = None, []
        for batch in batches:
            for row in batch.to_pylist():
                shard = row["shard"]
                packed.append(row["packed"])
        if shard is not None:
            keys, df = H.merged(packed)
            H.write_shard(folder, shard, keys=keys[df > 1], df=df[df > 1])
            yield H.rows_of("df", [shard], [b""])

    dealt = texts.mapInArrow(count, H.ROWS).repartitionById(shards, F.col("shard"))
    dealt.mapInArrow(write, H.ROWS).count()
    return Frequencies(folder, shards, rows)


class _Sampling:
    """Tables of the random numbers that a shingle's hash picks, for each sample."""

    BITS = 12
    C_BITS = 14

    def __init__(self, samples: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        # (r, beta, c) of the method: Gamma(2, 1), uniform, Gamma(2, 1), as equal shares of each
        self.r = np.sort(rng.gamma(2, 1, (64, 1 << self.BITS)), axis=1).mean(axis=0).astype(np.float32)
        c = np.sort(rng.gamma(2, 1, (64, 1 << self.C_BITS)), axis=1).mean(axis=0)
        self.log_c = np.log(c).astype(np.float32)
        self.inverse_r = 1 / self.r
        self.first = rng.integers(1 << 31, size=samples).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        self.second = rng.integers(1 << 31, size=samples).astype(np.uint32) * np.uint32(2) + np.uint32(1)

    def signatures(self, hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The least ln a of every text, per sample, as float32; texts without shingles keep zeros.

        ln a = ln c - ln y - r depends on shingle, sample and quantised weight only, so texts
        that take the same shingle at the same level have the very same number.
        """
        low, high = hashes.astype(np.uint32), (hashes >> _U(32)).astype(np.uint32)
        logs = np.log(weights).astype(np.float32)
        out = np.zeros((len(offsets) - 1, len(self.first)), np.float32)
        first = 0
        while first < len(out):
            # texts whose shingles stay in the processor's cache together; a longer one alone
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + (1 << 15), side="right")) - 1)
            a, b = offsets[first], offsets[last]
            filled = np.flatnonzero(np.diff(offsets[first : last + 1])) + first
            if len(filled):
                starts = offsets[filled] - a
                x, y, s = low[a:b], high[a:b], logs[a:b]
                for k, (m1, m2) in enumerate(zip(self.first, self.second)):
                    u = x * m1
                    u ^= y
                    u *= m2
                    u ^= u >> np.uint32(15)
                    u *= np.uint32(0x2C1B3C6D)
                    v = u * m1
                    v ^= v >> np.uint32(13)
                    at = u >> np.uint32(32 - self.BITS)
                    beta = (v & np.uint32(0xFFFF)).astype(np.float32)
                    beta *= np.float32(1 / 65536)
                    v *= np.uint32(0x297A2D39)
                    r = self.r[at]
                    level = s * self.inverse_r[at]
                    level += beta
                    np.floor(level, out=level)
                    level -= beta
                    level += np.float32(1)
                    level *= r
                    np.subtract(self.log_c[v >> np.uint32(32 - self.C_BITS)], level, out=level)
                    out[filled, k] = np.minimum.reduceat(level, starts)
            first = last
        return out


_SAMPLING = _Sampling(SAMPLES)


def _bands(signatures: np.ndarray) -> np.ndarray:
    """A hash per band, different for different bands."""
    bits = signatures.view(np.uint32).astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    mixed = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for row in range(ROWS):
        mixed = H.mix(mixed * _STEPS[1] + bits[:, :, row])
    return mixed.view(np.int64)


def _digests(texts: pa.Array) -> list[bytes]:
    return [xxhash.xxh3_128_digest(t.as_buffer() or b"") for t in texts]


def signed(docs: DataFrame, df: Frequencies, words: int = WORDS) -> DataFrame:
    """doc_id, digest of the text, its weight, samples and bands; weight 0 for a text without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, most=4 << 20):
            texts = texts_of(part)
            hashes, times, offsets = shingles(texts, words)
            weights = df.weights(hashes, times)
            signatures = _SAMPLING.signatures(hashes, weights, offsets)
            whole = np.add.reduceat(np.append(weights, 0.0), offsets[:-1])
            whole[np.diff(offsets) == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(_digests(texts), pa.binary()),
                    pa.array(whole, pa.float64()),
                    pa.array([s.tobytes() for s in signatures], pa.binary()),
                    pa.array(list(_bands(signatures)), pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "weight", "samples", "bands"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    ).mapInArrow(sign, "doc_id long, digest binary, weight double, samples binary, bands array<bigint>")


def weighted_jaccard(hashes_a, weights_a, hashes_b, weights_b) -> float:
    """Sum of lesser over sum of greater weights; both hash arrays are ascending and distinct."""
    _, in_a, in_b = np.intersect1d(hashes_a, hashes_b, assume_unique=True, return_indices=True)
    lesser = np.minimum(weights_a[in_a], weights_b[in_b]).sum()
    whole = weights_a.sum() + weights_b.sum() - lesser
    return float(lesser / whole) if whole else 0.0


def _agreeing(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose weights and samples allow the similarity that is wanted."""

    @F.arrow_udf("int")
    def agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.int32())
        x, y = (
            np.frombuffer(b"".join(side.to_pylist()), np.float32).reshape(len(side), -1) for side in (a, b)
        )
        return pa.array((x == y).sum(axis=1), pa.int32())

    side = lambda name: texts.select(
        F.col("node").alias(name), F.col("weight").alias(f"w{name}"), F.col("samples").alias(f"s{name}")
    )
    weighed = pairs.join(side("a"), "a").join(side("b"), "b")
    light = F.least("wa", "wb") >= (SIMILARITY - 1e-9) * F.greatest("wa", "wb")
    return weighed.where(light).where(agreeing("sa", "sb") >= LEAST_AGREEING).select("a", "b")


def _verified(pairs: DataFrame, bodies: DataFrame, df: Frequencies, similarity: float, words: int) -> DataFrame:
    """The pairs that are links, by the exact similarity of their texts."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts([batch], "ta", most=4 << 20):
                sides = []
                for column in ("ta", "tb"):
                    # the text compared with many others comes in row after row
                    encoded = part.column(column).dictionary_encode()
                    hashes, times, offsets = shingles(encoded.dictionary, words)
                    sides.append((encoded.indices.to_numpy(False), hashes, df.weights(hashes, times), offsets))
                keep = []
                for n in range(part.num_rows):
                    vectors = []
                    for place, hashes, weights, offsets in sides:
                        own = slice(offsets[place[n]], offsets[place[n] + 1])
                        vectors += [hashes[own], weights[own]]
                    keep.append(weighted_jaccard(*vectors) >= similarity)
                chosen = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [part.column("a").filter(chosen), part.column("b").filter(chosen)], names=["a", "b"]
                )

    side = lambda name: bodies.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb").mapInArrow(
        verify, "a long, b long"
    )


def _bodies(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Text of every node of `members` (node, doc_id, digest), one row each."""

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        return pa.array(_digests(pc.fill_null(texts, "")), pa.binary())

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    # a repeated doc_id may stand for several texts: the digest says which
    found = texts.join(members, "doc_id").where(digest("text") == F.col("digest")).select("node", "text")
    return found.dropDuplicates(["node"])


def _with_foremost(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of the text with most mates of each bucket and its other texts of other classes; each once."""
    ranked = placed.join(members.select("node", "mates"), "node")
    leads = ranked.groupBy("key").agg(F.max(F.struct("mates", "node", "class")).alias("_lead"))
    return placed.join(leads, "key").where(F.col("class") != F.col("_lead.class")).select(
        F.least("node", "_lead.node").alias("a"), F.greatest("node", "_lead.node").alias("b")
    ).distinct()


def _still_mixed(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Buckets that hold several classes, as rows (key, node, class)."""
    placed = shared.join(joined, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("class")
    )
    mixed = placed.groupBy("key").agg(
        F.min("class").alias("_least"), F.max("class").alias("_most")
    ).where(F.col("_least") != F.col("_most"))
    return placed.join(mixed.select("key"), "key")


def _compared_in_blocks(
    placed: DataFrame, members: DataFrame, bodies: DataFrame, df: Frequencies, similarity: float, words: int
) -> DataFrame:
    """Links between classes that still share buckets, found by comparing blocks of texts.

    Texts that hang together by such buckets make a group, dealt into blocks of about
    BLOCK_TEXTS. A task compares two blocks by their samples, checks what agrees enough
    exactly, and gives only links that join classes which nothing in the task has joined before,
    so fewer rows than texts.
    """
    first = placed.groupBy("key").agg(F.min("node").alias("a"))
    groups = components(placed.join(first, "key").select("a", F.col("node").alias("b")))
    own = placed.groupBy("node").agg(F.first("class").alias("class"))
    grouped = groups.withColumnRenamed("component", "group").join(own, "node")
    sizes = grouped.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("parts"))
    dealt = grouped.join(sizes, "group").withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    )
    blocks = stage(
        dealt.join(members.select("node", "samples"), "node").join(bodies, "node")
        .groupBy("group", "part").agg(F.collect_list(F.struct("node", "class", "samples", "text")).alias("rows")),
        "text-blocks",
    )
    ends = sizes.select("group", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("pa"))
    twos = ends.select("group", "pa", F.explode(F.sequence("pa", F.col("parts") - 1)).alias("pb"))
    side = lambda name: blocks.select(
        "group", F.col("part").alias(f"p{name}"), F.col("rows").alias(f"rows_{name}")
    )
    met = twos.join(side("a"), ["group", "pa"]).join(side("b"), ["group", "pb"])

    def described(rows: list[dict]):
        samples = np.frombuffer(b"".join(r["samples"] for r in rows), np.float32).reshape(len(rows), -1)
        hashes, times, offsets = shingles(pa.array([r["text"] or "" for r in rows], pa.string()), words)
        return samples, hashes, df.weights(hashes, times), offsets

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                sides = [(r, *described(r)) for r in (row["rows_a"], row["rows_b"])]
                parent: dict[int, int] = {}

                def root(x: int) -> int:
                    while parent.setdefault(x, x) != x:
                        x = parent[x]
                    return x

                (rows_a, samples_a, *vectors_a), (rows_b, samples_b, *vectors_b) = sides
                agreeing = np.zeros((len(rows_a), len(rows_b)), np.uint8)
                for k in range(SAMPLES):
                    agreeing += samples_a[:, k][:, None] == samples_b[:, k][None, :]
                found: list[tuple[int, int]] = []
                x, y = np.nonzero(agreeing >= LEAST_AGREEING)
                # the most alike first, so that later ones are mostly joined already
                for at in np.argsort(-agreeing[x, y].astype(int), kind="stable").tolist():
                    i, j = int(x[at]), int(y[at])
                    a, b = root(rows_a[i]["class"]), root(rows_b[j]["class"])
                    if a == b:
                        continue
                    (h, w, o), (g, v, q) = vectors_a, vectors_b
                    one, other = slice(o[i], o[i + 1]), slice(q[j], q[j + 1])
                    if weighted_jaccard(h[one], w[one], g[other], v[other]) >= similarity:
                        parent[max(a, b)] = min(a, b)
                        found.append((rows_a[i]["node"], rows_b[j]["node"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
                )

    return met.select("rows_a", "rows_b").mapInArrow(compare, "a long, b long")


def _in_two_bands(placed: DataFrame) -> DataFrame:
    """Buckets of texts that meet in two bands: (key, node) for every two keys of a text.

    A text has at most as many keys as there are bands.
    """
    keys = placed.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("k")).where(F.size("k") > 1)
    twos = keys.select("node", F.explode(F.expr(
        "flatten(transform(sequence(1, size(k) - 1), i -> "
        "transform(slice(k, i + 1, size(k)), other -> xxhash64(element_at(k, i), other))))"
    )).alias("key"))
    sizes = twos.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twos.join(sizes.select("key"), "key")


def classes(
    docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) and whether the row stands for its class.

    A row for every row of `docs`. Rows with a null doc_id are classes of their own with a null class_id, as are
    texts without words (class_id = doc_id).
    """
    df = frequencies(docs, words, shard_bytes)
    rows = stage(signed(docs, df, words), "signed")
    compared = rows.where((F.col("weight") > 0) & F.col("doc_id").isNotNull())
    texts = stage(
        compared.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.first("weight").alias("weight"),
            F.first("samples").alias("samples"), F.first("bands").alias("bands"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "texts",
    )
    buckets = texts.select("node", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(buckets.join(sizes, "key"), "buckets")
    mates = shared.groupBy("node").agg(F.sum("n").alias("mates"))
    members = stage(texts.join(mates, "node"), "members")
    bodies = stage(_bodies(docs, members.select("node", "doc_id", "digest")), "bodies")

    placed = shared.withColumn("class", F.col("node"))
    pairs = stage(_with_foremost(placed, members), "pairs")
    links = stage(_verified(_agreeing(pairs, members), bodies, df, similarity, words), "near-links")
    joined = stage(components(links), "components")
    shared = stage(_in_two_bands(_still_mixed(shared, joined)), "buckets")
    placed = _still_mixed(shared, joined)
    more = stage(_with_foremost(placed, members).join(pairs, ["a", "b"], "left_anti"), "pairs")
    found = _verified(_agreeing(more, members), bodies, df, similarity, words)
    links = stage(links.unionByName(found), "near-links")
    joined = stage(components(links), "components")
    placed = stage(_still_mixed(shared, joined), "open")
    if not placed.isEmpty():
        rest = _compared_in_blocks(placed, members, bodies, df, similarity, words)
        links = stage(links.unionByName(rest), "near-links")
        joined = stage(components(links), "components")

    # (digest, least doc_id of the class): a text of a class of its own stands for itself
    numbered = texts.select("node", "digest", "doc_id").join(joined, "node", "left")
    numbered = numbered.withColumn("component", F.coalesce("component", "node"))
    named = numbered.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    by_digest = numbered.join(named, "component").select("digest", "class_id")
    # only copies and members of larger classes need a look-up
    told = rows.select("doc_id", "digest", "weight").join(
        by_digest, "digest", "left"
    ).select(
        "doc_id",
        F.when((F.col("weight") > 0) & F.col("doc_id").isNotNull(), F.col("class_id"))
        .otherwise(F.col("doc_id")).alias("class_id"),
    )
    return told.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """`docs` with one document of each class; columns as they are.

    Of rows that repeat a kept doc_id one stays. Rows with a null doc_id stay.
    """
    name = free_name("_kept_id", docs.columns)
    kept = classes(docs, **options).where("kept and doc_id is not null").select(
        F.col("doc_id").alias(name)
    ).distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    same = F.col("doc_id").cast("long") == F.col(name)
    return named.join(kept, same, "left_semi").dropDuplicates(["doc_id"]).unionByName(
        docs.where(F.col("doc_id").isNull())
    )
