"""Vectors as rows of float64 bytes, for operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.operators.layout import stage

SCHEMA = "node long, vec_id long, vector binary"


def matrix(column: pa.Array) -> np.ndarray:
    """One row per value of a column of float64 bytes, none of them null."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float64).reshape(len(column), -1)


def numbered(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(node, vec_id, vector) of every row, stored; `vector` is null for rows that take no part.

    Those are null or zero vectors, vectors with null or non-finite components, and vectors of
    another length than the commonest. `node` tells rows of one vec_id apart.
    """
    chosen = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")
    )
    sizes = chosen.where("v is not null").groupBy(F.size("v").alias("n")).count()
    commonest = sizes.orderBy(F.desc("count"), "n").first()
    size = commonest["n"] if commonest else 0

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            fits = pc.fill_null(pc.equal(pc.list_value_length(lists), size), False).to_numpy(False)
            rows = np.full((batch.num_rows, size), np.nan)
            rows[fits] = lists.filter(pa.array(fits)).flatten().to_numpy(False).reshape(-1, size)
            good = np.isfinite(rows).all(axis=1) & (np.abs(rows).max(axis=1, initial=0) > 0)
            with np.errstate(over="ignore", invalid="ignore"):
                norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
            good &= np.isfinite(norms) & (norms > 0)
            vectors = [r.tobytes() if g else None for r, g in zip(rows, good)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("vec_id"), pa.array(vectors, pa.binary())],
                names=["node", "vec_id", "vector"],
            )

    return stage(
        chosen.withColumn("node", F.monotonically_increasing_id())
        .select("node", "vec_id", "v").mapInArrow(convert, SCHEMA),
        "vectors",
    )


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of `a` with the same row of `b`; equal rows give equal results anywhere."""
    dots = np.einsum("ij,ij->i", a, b)
    return dots / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def sample(vectors: DataFrame, rows: int, seed: int) -> np.ndarray:
    """At most `rows` unit vectors, chosen by hash of the row's number; this many reach the driver."""
    some = vectors.where("vector is not null")
    share = min(1.0, 1.2 * rows / max(1, some.count()))
    picked = (
        some.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1_000_000)) < share * 1_000_000)
        .select("node", "vector").limit(rows).collect()
    )
    picked.sort(key=lambda r: r["node"])
    data = np.frombuffer(b"".join(bytes(r["vector"]) for r in picked), np.float64)
    return unit(data.reshape(len(picked), -1)) if picked else np.zeros((0, 0))
