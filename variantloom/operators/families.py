"""Families of two-class models that share cells. A member's cells (a barcode's, a pool's) go packed to each task that has models
over them, so what is shuffled grows with the tasks and not with the models; small models are grown many at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.naming import col
from . import pools
from .boosting import CHUNK, Booster, Params, aurocs, bins_of, edges_of, edges_of_sorted, fit_together
from .packed import HELD, PACKED, Cells, draw_number, pack, split_of

SHARES = {"train": 0.8, "eval": 0.1, "test": 0.1}
RESULTS = "key string, n_train long, n_eval long, n_test long, train_auroc double, eval_auroc double, test_auroc double, train_accuracy double, eval_accuracy double, test_accuracy double, model string, importance map<string,double>, error string"

#: Pairs: blocks that members are dealt to, unless a block then holds more than BLOCK bytes; a task has two blocks, so a cell is sent once for each block.
BLOCKS, MEMBERS, BLOCK = 16, 16, 64 << 20
#: Copies of a pool that are sent to tasks, in bytes, beyond one copy for each core.
COPIES = 512 << 20
#: Rows of models that are grown together, each counted as the largest.
TOGETHER = 1 << 19


@dataclass(frozen=True)
class Sides:
    """Members, and which two each model tells apart: with a pool every other member (1) from it (0); without, each two members a < b, as text, of which a is 1, by the key `a|b`.

    rows: the same with one row for each cell and key; cells: each cell once, its member in the column `member`; tell: else models and importance aren't written out."""

    rows: DataFrame
    cells: DataFrame
    member: str
    pool: str | None = None
    tell: bool = True

    def groupBy(self, *by):
        return self.rows.groupBy(*by)

    def train(self, features: list[str], ids, params: Params, seed: int) -> DataFrame:
        width, own = len(features), col(self.member).cast("string")
        slim = self.cells.select(own, F.lit(""), draw_number(seed, ids), *(col(f).cast("double").alias(f"x{j}") for j, f in enumerate(features)))
        packed, pooled = slim.mapInArrow(pack(width), PACKED), own.eqNullSafe(F.lit(self.pool))
        sizes = self.cells.groupBy(pooled.alias("pooled"), own).agg(F.count("*").alias("n"), F.approx_count_distinct(F.when(pooled, F.xxhash64(*map(col, features)))).alias("sets"))
        in_pool = F.col("pooled")
        members, n, most, n_pool, n_sets = sizes.agg(F.count_if(~in_pool), F.coalesce(F.sum(F.when(~in_pool, F.col("n"))), F.lit(0)), F.max(F.when(~in_pool, F.col("n"))), F.coalesce(F.max(F.when(in_pool, F.col("n"))), F.lit(0)), F.max("sets")).first()
        sets = n_pool > CHUNK and n_sets < pools.MOST and params.max_depth <= 8
        if sets:
            counted = pools.counted(self.cells.where(pooled), features, ids, seed, n_pool, SHARES)
            counted = counted.select(F.lit(self.pool), F.lit(""), F.lit(0).cast("long"), *(F.col(c).cast("double") for c in counted.columns))
            packed, n_pool = slim.where(~pooled).mapInArrow(pack(width), PACKED).unionByName(counted.mapInArrow(pack(width + len(SHARES)), PACKED)), 2 * n_sets
        if self.pool is None:
            blocks = max(1, min(BLOCKS, -(-members // MEMBERS)), -(-n * 8 * (width + 1) // BLOCK))
            tasks, block = blocks * (blocks + 1) // 2, F.pmod(F.hash("key"), F.lit(blocks))
            every = F.sequence(F.lit(0), F.lit(blocks - 1))
            to = F.transform(every, lambda k: (F.greatest("block", k) * (F.greatest("block", k) + 1) / 2).cast("int") + F.least("block", k))
        else:
            cores = self.cells.sparkSession.sparkContext.defaultParallelism
            tasks = max(1, min(members, max(cores, min(4 * cores, COPIES // max(1, n_pool * 8 * (width + 1))))))
            block = F.when(F.col("key") == self.pool, -1).otherwise(F.pmod(F.hash("key"), F.lit(tasks)))
            to = F.when(F.col("block") < 0, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array("block"))
        sent = packed.withColumn("block", block.cast("int")).withColumn("task", F.explode(to))
        # dealt by the task's number itself: a hash of few tasks puts several into one
        return sent.repartitionById(tasks, F.col("task")).sortWithinPartitions("task", "key").mapInArrow(_trained(features, params, self.pool, self.tell, most if sets else None), RESULTS)


class Member:
    """A member's cells in the order of their draws, dealt to parts."""

    def __init__(self, batches: Iterator[pa.RecordBatch], width: int):
        first = next(batches)
        self.block = first.column(5)[0].as_py()
        self._cells = Cells((b for some in ([first], batches) for b in some), width, True)
        self.key, self.size = self._cells.key, len(self._cells)
        parts = split_of(np.zeros(self.size, np.int8), SHARES)
        self.at = [np.flatnonzero(parts == i) for i in range(len(SHARES))]
        self.draws = self._cells.draws[self.at[0]]
        self._held = None
        if self.size * width * 8 <= HELD:
            self._held = [self._cells.column(j)[np.concatenate(self.at)] for j in range(width)]
            self._cells = None

        self._ranked = {}

    def ranked(self, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a feature's values that are there: those to train on and all, in ascending order; and every value's place among all, with missing ones last."""
        if j not in self._ranked:
            v, t = self._held[j], len(self.at[0])
            order, rank = np.argsort(v, kind="stable"), np.empty(len(v), np.int32)
            rank[order] = np.arange(len(v), dtype=np.int32)
            self._ranked[j] = np.sort(v[:t][np.isfinite(v[:t])]), v[order][: int(np.isfinite(v).sum())], rank
        return self._ranked[j]

    def binned(self, j: int, edges: np.ndarray, bins: int) -> np.ndarray:
        """bins_of a feature's values."""
        _, v, rank = self.ranked(j)
        ends = np.empty(len(edges) + 2, np.intp)
        ends[0], ends[1:-1], ends[-1] = 0, np.searchsorted(v, edges, "right"), len(v)
        out = np.full(len(rank), bins, np.uint8 if bins < 256 else np.int64)
        out[: len(v)] = np.repeat(np.arange(len(edges) + 1, dtype=out.dtype), ends[1:] - ends[:-1])
        return out[rank]

    def column(self, j: int) -> list[np.ndarray]:
        """A feature's values by part."""
        v = self._cells.column(j)[np.concatenate(self.at)] if self._held is None else self._held[j]
        return np.split(v, np.cumsum([len(a) for a in self.at[:-1]]))


def _task(i: int, j: int) -> int:
    """The number of the task with these two blocks (or this one)."""
    low, high = min(i, j), max(i, j)
    return high * (high + 1) // 2 + low


def _group(a: Member, b: Member, width: int, bins: int) -> tuple:
    """Edges, bins, classes (a is 1) and the sizes of the parts, rows to train on in the order of their draws."""
    order = np.argsort(np.concatenate([a.draws, b.draws]), kind="stable")  # of two runs: merged
    n = [len(x) + len(y) for x, y in zip(a.at, b.at)]
    y = np.concatenate([np.repeat([1, 0], [len(a.at[0]), len(b.at[0])])[order], *(np.repeat([1, 0], [len(p), len(q)]) for p, q in zip(a.at[1:], b.at[1:]))])
    edges, binned = [], np.empty((len(y), width), np.uint8 if bins < 256 else np.int64, "F")
    if a._held is not None and b._held is not None:  # in order already: merged, and binned by places
        t, u = len(a.at[0]), len(b.at[0])
        rest = np.concatenate([*(np.arange(k, k + len(p)) for k, p in ((t, a.at[1]), (a.size + u, b.at[1]))), *(np.arange(k, k + len(p)) for k, p in ((t + len(a.at[1]), a.at[2]), (a.size + u + len(b.at[1]), b.at[2])))])
        to = np.concatenate([np.concatenate([np.arange(t), np.arange(a.size, a.size + u)])[order], rest])
        for j in range(width):
            v = np.concatenate([a.ranked(j)[0], b.ranked(j)[0]])
            v.sort(kind="stable")
            edges.append(edges_of_sorted(v, bins))
            binned[:, j] = np.concatenate([a.binned(j, edges[j], bins), b.binned(j, edges[j], bins)])[to]
        return edges, binned, y, n
    for j in range(width):  # one feature's values at a time
        v = np.concatenate([x for both in zip(a.column(j), b.column(j)) for x in both])
        edges.append(edges_of(v[: n[0]], bins))
        v = bins_of(v, edges[j], bins)
        binned[: n[0], j], binned[n[0] :, j] = v[: n[0]][order], v[n[0] :]
    return edges, binned, y, n


def _alone(features: list[str], params: Params, edges: list, b: np.ndarray, y: np.ndarray, n: list[int]) -> tuple[Booster, np.ndarray]:
    t, v = n[0], n[0] + n[1]
    model = Booster(features, 2, params).fit_binned(edges, b[:t], y[:t], b[t:v], y[t:v])
    return model, model.predict_binned(edges, b)


def _rows(keys: list[str], groups: list[tuple], fits: list[tuple[Booster | None, np.ndarray]]) -> list[dict]:
    out = [{"key": k, "model": m and m.dump(), "importance": m and list(m.importance().items()), "error": None} for k, (m, _) in zip(keys, fits)]
    of = np.concatenate([np.repeat(3 * i + np.arange(3), g[3]) for i, g in enumerate(groups)])
    y, prob = np.concatenate([g[2] for g in groups]), np.concatenate([p for _, p in fits])
    n, right, auroc = np.bincount(of, minlength=3 * len(keys)), np.bincount(of, (prob >= 0.5) == y, 3 * len(keys)), aurocs(y, prob, of, 3 * len(keys))
    accuracy = (right / np.maximum(n, 1)).tolist()
    n, auroc = n.tolist(), auroc.tolist()
    for i, row in enumerate(out):
        for j, s in enumerate(SHARES):
            k = 3 * i + j
            row[f"n_{s}"], row[f"{s}_auroc"], row[f"{s}_accuracy"] = n[k], auroc[k] if auroc[k] == auroc[k] else None, accuracy[k] if n[k] else None
    return out


def _fits(features: list[str], params: Params, keys: list[str], groups: list[tuple], tell: bool = True) -> list[dict]:
    """Rows of results; data that can't be trained on must not stop the other models, so its row says why."""
    try:
        if len(keys) > 1:
            edges, b, y, n = zip(*groups)
            return _rows(keys, groups, fit_together(features, params, list(edges), list(b), list(y), [x[0] for x in n], [x[1] for x in n], tell))
        model, prob = _alone(features, params, *groups[0])
        return _rows(keys, groups, [(model if tell else None, prob)])
    except (ValueError, ArithmeticError, np.linalg.LinAlgError) as e:
        if len(keys) > 1:
            return [r for k, g in zip(keys, groups) for r in _fits(features, params, [k], [g], tell)]
        return [{"key": keys[0], "error": f"{type(e).__name__}: {e}"} | {f"n_{s}": n for s, n in zip(SHARES, groups[0][3])}]


def _trained(features: list[str], params: Params, pool: str | None, tell: bool = True, most_cells: int | None = None):
    width, schema = len(features), to_arrow_schema(StructType.fromDDL(RESULTS))

    def sides(task: int, members: list[Member]) -> Iterator[tuple[str, Member, Member]]:
        if pool is not None:
            yield from ((m.key, m, p) for p in members if p.key == pool for m in members if m is not p)
            return
        for i, a in enumerate(members):  # by key
            yield from ((f"{a.key}|{b.key}", a, b) for b in members[i + 1 :] if _task(a.block, b.block) == task)

    def fitted(keys: list[str], groups: list[tuple]) -> pa.RecordBatch:
        rows = _fits(features, params, keys, groups, tell)
        return pa.RecordBatch.from_pylist([{f: r.get(f) for f in schema.names} for r in rows], schema)

    def counted(key: str, values: list[list[np.ndarray]], cells: pools.Pool) -> pa.RecordBatch:
        try:
            model, row = pools.fit(features, params, cells, values)
            row |= {"model": model.dump() if tell else None, "importance": list(model.importance().items()) if tell else None}
        except (ValueError, ArithmeticError, np.linalg.LinAlgError) as e:
            row = {"error": f"{type(e).__name__}: {e}"} | {f"n_{s}": len(v) + int(c.sum()) for s, v, c in zip(SHARES, values[0] if values else [[]] * len(SHARES), cells.counts)}
        return pa.RecordBatch.from_pylist([{f: (row | {"key": key}).get(f) for f in schema.names}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (b.slice(i, 1) for b in batches for i in range(b.num_rows))
        for task, own in groupby(rows, lambda r: r.column(6)[0].as_py()):
            members = [pools.Pool(few, width, params, most_cells) if most_cells is not None and key == pool else Member(few, width) for key, few in groupby(own, lambda r: r.column(0)[0].as_py())]
            keys, groups, most = [], [], 0
            for key, a, b in sides(task, members):
                if most_cells is not None:
                    yield counted(key, [a.column(j) for j in range(width)], b)
                    continue
                group = _group(a, b, width, params.bins)
                if len(group[2]) > CHUNK // 4 or params.max_depth > 8 or width > 10_000:
                    yield fitted([key], [group])
                    continue
                if keys and max(most, len(group[2])) * (len(keys) + 1) > TOGETHER:  # each takes the room of the largest
                    yield fitted(keys, groups)
                    keys, groups, most = [], [], 0
                keys.append(key)
                groups.append(group)
                most = max(most, len(group[2]))
            if keys:
                yield fitted(keys, groups)

    return run
