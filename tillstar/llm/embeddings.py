"""Embedding near-dedup by product quantisation, without losing a link.

Vectors that link have the same label, the same number of components and a cosine of at
least `cosine`; on unit vectors, a distance of at most r = sqrt(2 - 2 cosine).

* Coarse inverted lists: every unit vector belongs to the list of its nearest coarse
  centroid. Its residual is coded by the nearest codeword in each of `subspaces` parts,
  and the length of what the codes leave out (its error) is kept beside them.
* Sufficient probes: a vector within r of the query can be in another list only if the
  query lies within r of the plane halfway between that list's centroid and its own. All
  lists for which that holds are probed.
* Asymmetric distances: a table of squared distances from the query's residual to each
  codeword is looked up and summed by the members' codes. By the triangle inequality, no
  linked member has an asymmetric distance over r plus its own error; what is under that
  is a candidate, and the exact cosine in double precision decides.

So links depend on centroids and codewords in speed only; these are fitted to a bounded
sample. Equal vectors are one class, compared once. Lists are cut into blocks of members
and of queries, and a task compares a block with a block; from each, it hands on the
number of links per class and as many edges as connect them, not the pairs.

Vectors that are null, empty, zero, without a label, or hold null or non-finite
components link with nothing. Repeated rows count as vectors of their own. An empty table
gives an empty one. Rows without an id take part; they are never a component's name, and are kept
only where no row that links reach has an id.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tillstar.llm.common import components, written

COSINE = 0.98
#: Vectors that centroids and codewords are fitted to, about; twice as many at most.
SAMPLE = 16384
SUBSPACES = 8
CODEWORDS = 256
#: Members wanted in a coarse list, over all labels, and the most lists.
PER_LIST = 2000
LISTS = 1024
MEMBERS, QUERIES = 2000, 4000
#: More than single precision can be out by, in distances between unit vectors.
SLACK = 1e-3


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(1) - 2 * x @ centers.T, axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """At most k centers; those that lose all their points stay where they were."""
    random = np.random.default_rng(seed)
    centers = x[random.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, centers)
        n = np.bincount(at, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, at, x)
        centers[n > 0] = total[n > 0] / n[n > 0, None]
    return centers


@dataclass(frozen=True)
class Index:
    """Coarse centroids (lists x dimension) and codewords (subspaces x codewords x part)."""

    centroids: np.ndarray
    codewords: np.ndarray
    radius: float

    @property
    def dimension(self) -> int:
        return self.centroids.shape[1]

    @functools.cached_property
    def apart(self) -> np.ndarray:
        """Distances between centroids (lists x lists)."""
        norms = (self.centroids**2).sum(1)
        squared = norms[:, None] + norms - 2 * self.centroids @ self.centroids.T
        np.fill_diagonal(squared, 0)
        return np.sqrt(np.maximum(0, squared))

    def parts(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), len(self.codewords), -1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and error of each unit vector."""
        at = _nearest(x, self.centroids)
        parts = self.parts(x - self.centroids[at])
        codes = np.stack([_nearest(parts[:, s], w) for s, w in enumerate(self.codewords)], axis=1)
        built = np.stack([w[codes[:, s]] for s, w in enumerate(self.codewords)], axis=1)
        return at, codes.astype(np.uint8), np.sqrt(((parts - built) ** 2).sum((1, 2)))

    def probes(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which lists may hold a vector within the radius, as booleans per vector."""
        squared = (x**2).sum(1)[:, None] + (self.centroids**2).sum(1) - 2 * x @ self.centroids.T
        own = squared[np.arange(len(x)), at][:, None]
        near = (squared - own) <= 2 * (self.radius + 1e-9) * (self.apart[at] + 1e-7) + 1e-9
        return near & (np.arange(len(self.centroids)) >= at[:, None])

    def distances(self, x: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of unit vectors to the coded members of the list `place`, in
        single precision: right to within SLACK."""
        parts = self.parts(x - self.centroids[place]).astype(np.float32)
        total = np.zeros((len(x), len(codes)), np.float32)
        for s, words in enumerate(self.codewords.astype(np.float32)):
            table = (parts[:, s] ** 2).sum(1)[:, None] - 2 * (parts[:, s] @ words.T) + (words**2).sum(1)
            total += np.take(table, codes[:, s], axis=1)
        return np.sqrt(np.maximum(total, 0, out=total), out=total)


def fit(x: np.ndarray, lists: int, cosine: float, subspaces: int = SUBSPACES) -> Index:
    centroids = kmeans(x, lists)
    parts = (x - centroids[_nearest(x, centroids)]).reshape(len(x), subspaces, -1)
    words = np.stack([kmeans(parts[:, s], min(CODEWORDS, len(x))) for s in range(subspaces)])
    return Index(centroids, words, float(np.sqrt(max(0.0, 2 - 2 * cosine))))


def _plain(vectors, dimension: int, dtype=np.float64) -> np.ndarray:
    """Vectors as rows, with zeros up to `dimension`; doubles are scaled to a largest
    component of one, so that no square overflows."""
    out = np.zeros((len(vectors), dimension), dtype)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out / np.abs(out).max(1, keepdims=True) if len(out) and dtype == np.float64 else out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64, copy=False)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link at all."""
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(label.isNotNull() & F.forall(vector, plain) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node reachable from each of n nodes over edges a-b."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (before == root).all():
            return root


def _compare(index: Index, cosine: float, dtype):
    """Links between a block of queries and a block of members of one list."""

    def block(key, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = {"cid": [], "other": [], "links": []}
        if len(queries) and len(members):
            read = lambda rows: np.frombuffer(b"".join(rows["vec"]), dtype).reshape(len(rows), -1).astype(np.float64)
            x, y = read(queries), read(members)
            ux, ny = _unit(x), np.linalg.norm(y, axis=1)
            codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(members), -1)
            q, m, home = queries["cid"].to_numpy(), members["cid"].to_numpy(), queries["home"].to_numpy()
            reach = (index.radius + members["error"].to_numpy() + SLACK).astype(np.float32)
            found = []
            for at in range(0, len(x), 256):
                near = index.distances(ux[at : at + 256], int(key[2]), codes) <= reach
                once = (home[at : at + 256, None] != key[2]) | (q[at : at + 256, None] < m)
                i, j = np.nonzero(near & once)
                i = i + at
                for k in range(0, len(i), 65536):
                    a, b = i[k : k + 65536], j[k : k + 65536]
                    exact = np.einsum("ij,ij->i", x[a], y[b]) / (np.linalg.norm(x[a], axis=1) * ny[b]) >= cosine
                    found.append((a[exact], b[exact]))
            a, b = (np.concatenate([f[s] for f in found]) if found else np.zeros(0, int) for s in (0, 1))
            if len(a):
                ids, both = np.unique(np.concatenate([q[a], m[b]]), return_inverse=True)
                weight = np.concatenate([members["n"].to_numpy()[b], queries["n"].to_numpy()[a]])
                root = _roots(both[: len(a)], both[len(a) :], len(ids))
                out = {"cid": ids, "other": ids[root], "links": np.bincount(both, weights=weight).astype(np.int64)}
        return pd.DataFrame(out).astype("int64")

    return block


def near_duplicates(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
    sample: int = SAMPLE, per_list: int = PER_LIST, members: int = MEMBERS, queries: int = QUERIES,
) -> DataFrame:
    """One row per row of `df`: id, n_links (other vectors linked directly), component_id
    (the smallest id that links reach, its own included) and kept (id = component_id)."""
    can = usable(F.col(vector), F.col(label))
    rows = df.select(F.col(id).alias("id"), F.when(can, F.col(vector)).alias("vec"), F.when(can, F.col(label)).alias("label"))
    # A class is all rows of one vector and label; its number holds once it is written.
    classes = written(
        rows.where("vec is not null").groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    size = classes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not size["n"]:
        return df.select(id, F.lit(0).cast("long").alias("n_links"), F.col(id).alias("component_id"), F.lit(True).alias("kept"))
    dimension = -(-size["d"] // SUBSPACES) * SUBSPACES
    # By hash, so that no task hands on more than its part of the sample.
    one_in = -(-size["n"] // sample)
    chosen = classes.select("cid", "vec").where(F.pmod(F.xxhash64("cid"), F.lit(one_in)) == 0).limit(2 * sample).collect()
    chosen.sort(key=lambda r: r["cid"])
    chosen = chosen or [classes.select("cid", "vec").first()]  # few classes, none of them hit
    index = fit(_unit(_plain([r["vec"] for r in chosen], dimension)), max(1, min(LISTS, size["n"] // per_list)), cosine)

    # Single precision is stored as such; every cosine is taken in double precision.
    dtype = np.float32 if isinstance(df.schema[vector].dataType.elementType, FloatType) else np.float64

    def encode(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                x = _plain(part["vec"].to_list(), dimension, dtype)
                place, codes, error = index.encode(_unit(x))
                probes = index.probes(_unit(x), place)
                yield pd.DataFrame({
                    "cid": part["cid"].to_numpy(), "label": part["label"].to_numpy(), "d": part["vec"].map(len).to_numpy(),
                    "n": part["n"].to_numpy(), "vec": [v.tobytes() for v in x], "list": place,
                    "codes": [c.tobytes() for c in codes], "error": error, "probes": [np.nonzero(p)[0] for p in probes],
                })

    kind = classes.schema["label"].dataType.simpleString()
    coded = written(
        classes.mapInPandas(encode, f"cid long, label {kind}, d int, n long, vec binary, list int, codes binary, error double, probes array<int>"),
        "codes",
    )
    key = ["label", "d", "list"]
    # Aliased, as both sides of a cogroup need columns of their own.
    asked = coded.select(*[F.col(c).alias(c) for c in ("cid", "label", "d", "n", "vec")], F.col("list").alias("home"), F.explode("probes").alias("list"))
    blocks = (
        coded.groupBy(*key).agg(F.ceil(F.count("*") / members).cast("int").alias("parts"))
        .join(asked.groupBy(*key).agg(F.ceil(F.count("*") / queries).cast("int").alias("turns")), key)
    )
    own = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = asked.join(blocks, key).select(*key, every("parts").alias("part"), own("turns").alias("turn"), "cid", "n", "vec", "home")
    asked_of = coded.join(blocks, key).select(*key, own("parts").alias("part"), every("turns").alias("turn"), "cid", "n", "vec", "codes", "error")
    full = [*key, "part", "turn"]
    found = written(
        asking.groupBy(*full).cogroup(asked_of.groupBy(*full)).applyInPandas(_compare(index, cosine, dtype), "cid long, other long, links long"),
        "links",
    )

    reach = components(found, "cid", "other").withColumnRenamed("node", "cid")
    linked = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = classes.join(reach, "cid", "left").join(linked, "cid", "left").select(
        "label", "vec", "least", F.coalesce("component", "cid").alias("component"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = named.join(smallest, "component").select(F.col("label").alias("l"), F.col("vec").alias("v"), "n_links", "component_id")
    alone = rows.where("vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    grouped = rows.where("vec is not null")
    all_ = grouped.join(result, (grouped["label"] == F.col("l")) & (grouped["vec"] == F.col("v"))).select("id", "n_links", "component_id").union(alone)
    return all_.select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
