"""Approximate nearest neighbours by multi-index hashing.

Vectors are turned into binary codes by rotations that are learned so that the
signs lose little (iterative quantisation). A code is cut into substrings, and every
substring is an index of its own. Two codes within radius r must agree in one of m
substrings up to r // m bits (pigeonhole), so a query probes every substring index
at that small radius, which retrieves every code within the radius. What is found is
ranked by the cosine of the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cornerstore.llm.frames import bounded_sample, map_columns
from cornerstore.session import write_and_reread

SAMPLE_ROWS = 4096
CODE_BITS = 128
SUBSTRING_BITS = 32
PREFIX_BITS = 4
RADIUS_RECALL = 0.985
GROUP_ROWS = 16_384
GROUP_QUERIES = 4_096
QUERY_STEP = 256


@dataclass
class Codes:
    """Learned rotations (dimensions x bits) and the Hamming radius to search."""

    rotations: np.ndarray
    radius: int

    @property
    def substrings(self) -> int:
        return self.rotations.shape[1] // SUBSTRING_BITS

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """rows x substrings, unsigned 32-bit."""
        bits = (vectors @ self.rotations) > 0
        return np.packbits(bits, axis=1).view(">u4").astype(np.uint32)


def substring_radii(radius: int, substrings: int) -> list[int]:
    """Radii whose sum plus their number is over ``radius``: one of the substrings must be within its own."""
    each, rest = divmod(radius, substrings)
    return [each if k <= rest else each - 1 for k in range(substrings)]


def learn_rotations(sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Orthogonal rotations, side by side up to ``bits`` columns, by iterative quantisation."""
    random = np.random.default_rng(seed)
    size = sample.shape[1]
    blocks = []
    while sum(b.shape[1] for b in blocks) < bits:
        rotation = np.linalg.qr(random.standard_normal((size, size)))[0]
        for _ in range(rounds):
            turned = sample @ rotation
            left, _, right = np.linalg.svd(sample.T @ np.where(turned > 0, 1.0, -1.0))
            rotation = left @ right
        blocks.append(rotation)
    return np.concatenate(blocks, axis=1)[:, :bits]


def valid_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """id, v (array of double) of the vectors that take part.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, rows
    without an id, and vectors of another length than most have take no part.
    """
    parts = vectors.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("v")
    ).filter(
        "id is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
        " and exists(v, x -> x <> 0)"
    )
    most = parts.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return parts.filter(F.size("v") == (most["n"] if most else 0))


def fit_codes(
    vectors: DataFrame, bits: int = CODE_BITS, neighbours: int = 5, recall: float = RADIUS_RECALL,
    rows: int = SAMPLE_ROWS,
) -> Codes | None:
    """Rotations and radius from at most about ``rows`` vectors; None for an empty table.

    The radius holds ``recall`` of the sample's own nearest pairs. In the whole table
    the nearest are nearer than in a sample, so the radius errs on the wide side.
    """
    found = bounded_sample(vectors, "id", rows, vectors.count()).select("v").limit(2 * rows).toPandas()["v"]
    if not len(found):
        return None
    sample = unit(np.array(found.tolist(), dtype=np.float64))
    codes = Codes(learn_rotations(sample, bits), bits)
    packed = codes.encode(sample)
    tries = np.arange(0, len(sample), max(1, len(sample) // 512))
    near = sample[tries] @ sample.T
    near[np.arange(len(tries)), tries] = -2
    k = min(neighbours, len(sample) - 1)
    if k < 1:
        return codes
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    apart = np.bitwise_count(packed[tries][:, None, :] ^ packed[best]).sum(axis=2, dtype=np.int64)
    codes.radius = min(bits, int(np.quantile(apart, recall)) + 1)
    return codes


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal values wherever they stand.

    Rows are scaled by a power of two first, so that squares of very large or very
    small components neither overflow nor vanish; that changes no other result.
    """
    a, b = (np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1]) for rows in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def coded(vectors: DataFrame, codes: Codes) -> DataFrame:
    """id, v (doubles as bytes), c (substrings as array of long)."""
    def run(values):
        if not values:
            return
        rows = np.array(values, dtype=np.float64)
        for row, code in zip(rows, codes.encode(unit(rows))):
            yield row.tobytes(), code.astype(np.int64)

    return map_columns(vectors, ["v"], run, "id long, v binary, c array<long>", ("id",))


def best_in_group(
    queries: pd.DataFrame, index: pd.DataFrame, table: int, radius: int, radii: list[int], k: int
) -> pd.DataFrame:
    """query_id, vec_id, score: the k nearest that substring ``table`` is the first to retrieve."""
    out = []
    if index["id"].duplicated().any():
        index = index.drop_duplicates(["id", "v"])
    if len(queries) and len(index):
        as_rows = lambda frame: np.frombuffer(b"".join(frame["v"]), np.float64).reshape(len(frame), -1)
        codes = lambda frame: np.array(frame["c"].tolist(), dtype=np.int64).astype(np.uint32)
        vectors, ids, known = as_rows(index), index["id"].to_numpy(), codes(index)
        normed = unit(vectors)
        # Rows sorted by id: the first row of each id, and the number of the id that each row has.
        by_id = np.argsort(ids, kind="stable")
        firsts = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[0]] - 1))
        of_id = np.empty(len(ids), dtype=np.int64)
        of_id[by_id] = np.repeat(np.arange(len(firsts)), np.diff(firsts, append=len(ids)))
        repeats = len(firsts) < len(ids)
        all_queries, all_ids, all_codes = as_rows(queries), queries["id"].to_numpy(), codes(queries)
        for start in range(0, len(queries), QUERY_STEP):
            part = slice(start, start + QUERY_STEP)
            total = np.zeros((len(all_ids[part]), len(ids)), dtype=np.int16)
            hit = np.ones(total.shape, dtype=bool)
            for j, most in enumerate(radii):
                apart = np.bitwise_count(all_codes[part, j][:, None] ^ known[:, j][None, :])
                total += apart
                if j == table:
                    hit &= apart <= most
                elif j < table:
                    hit &= apart > most
            hit &= total <= radius
            hit &= all_ids[part][:, None] != ids[None, :]
            near = np.where(hit, unit(all_queries[part]) @ normed.T, -2.0)
            for row in np.flatnonzero(hit.any(axis=1)):
                # Each id takes one place, with its nearest row.
                each = np.maximum.reduceat(near[row][by_id], firsts) if repeats else near[row]
                least = -2.0 if len(each) <= k else np.partition(each, len(each) - k)[len(each) - k]
                wanted = np.maximum(each[of_id], least) if repeats else least
                at = np.flatnonzero(hit[row] & (near[row] >= wanted - 1e-9))
                score = cosine(np.repeat(all_queries[part][row:row + 1], len(at), axis=0), vectors[at])
                best: dict[int, float] = {}
                for i in np.lexsort((ids[at], -score)):
                    best.setdefault(int(ids[at[i]]), float(score[i]))
                    if len(best) == k:
                        break
                out += [(int(all_ids[part][row]), v, s) for v, s in best.items()]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def _search(index: DataFrame, queries: DataFrame, codes: Codes, radius: int, k: int) -> DataFrame:
    """query_id, vec_id, score: some of them more than k a query, the nearest k among them."""
    m, radii = codes.substrings, substring_radii(radius, codes.substrings)
    shift = SUBSTRING_BITS - PREFIX_BITS
    number = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    prefix = F.shiftright(F.get("c", F.col("j")), shift).cast("int")
    entries = index.select("id", "v", "c", number.alias("j")).withColumn("prefix", prefix)
    # Rows per substring and prefix: m x 2^PREFIX_BITS numbers. Full ones are dealt to several groups.
    sizes = {(r["j"], r["prefix"]): r["n"] for r in entries.groupBy("j", "prefix").agg(F.count("*").alias("n")).collect()}
    salts = [-(-sizes.get((j, p), 0) // GROUP_ROWS) for j in range(m) for p in range(1 << PREFIX_BITS)]
    blocks = max(1, -(-queries.count() // GROUP_QUERIES))
    dealt = F.array(*map(F.lit, salts))
    of = F.get(dealt, F.col("j") * (1 << PREFIX_BITS) + F.col("prefix"))
    left = entries.withColumn("salt", F.pmod(F.xxhash64("id"), of).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    most = F.get(F.array(*map(F.lit, radii)), F.col("j"))
    right = (
        queries.select("id", "v", "c", number.alias("j")).withColumn("own", prefix)
        .withColumn("prefix", F.explode(F.sequence(F.lit(0), F.lit((1 << PREFIX_BITS) - 1))))
        .filter(F.bit_count(F.col("own").bitwiseXOR(F.col("prefix"))) <= most)
        .withColumn("salts", of).filter("salts > 0")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    )
    keys = ["j", "prefix", "salt", "block"]

    def group(key, found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return best_in_group(asked, found, int(key[0]), radius, radii, k)

    columns = [*keys, "id", "v", "c"]
    return left.select(*columns).groupBy(*keys).cogroup(right.select(*columns).groupBy(*keys)).applyInPandas(
        group, "query_id long, vec_id long, score double"
    )


def nearest(
    vectors: DataFrame, key: str, column: str, query_filter: str, k: int = 5, codes: Codes | None = None
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query, by cosine.

    Queries are the valid rows that ``query_filter`` (on id) selects, against every
    valid row but their own; ties go to the smaller id. Every row is indexed. Queries
    that have fewer than k neighbours within the radius are searched again without
    a radius, so each gets k, or all there are. Rows that repeat an id count once, with
    their nearest vector. Equal vectors in any number fall into several groups. No
    valid row: an empty result.
    """
    parts = valid_vectors(vectors, key, column)
    codes = codes or fit_codes(parts, neighbours=k)
    if codes is None:
        codes = Codes(np.eye(SUBSTRING_BITS), SUBSTRING_BITS)
        return parts.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(1.0).alias("score")
        ).filter("false")
    index = write_and_reread(coded(parts, codes), "hamming-codes")
    queries = index.filter(query_filter)
    found = write_and_reread(_search(index, queries, codes, codes.radius, k), "hamming-found")
    # A query has its own row as well, so k + 1 rows must be there for k neighbours.
    there = min(k, index.select("id").distinct().limit(k + 1).count() - 1)
    enough = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= there)
    short = queries.join(enough, queries["id"] == enough["query_id"], "left_anti")
    if there > 0 and short.limit(1).count():
        everything = codes.substrings * SUBSTRING_BITS
        found = found.unionByName(_search(index, short, codes, everything, k))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id"))
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
