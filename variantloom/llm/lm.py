"""Language-model scoring by a weighted backoff automaton.

The model is a Dirichlet-smoothed n-gram model, normalised at every history h:
p(w|h) = (c(hw) + m p(w|h')) / (c(h) + m), down to p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).
For an n-gram that was never seen it is m / (c(h) + m) times p(w|h'): a failure arc with a weight.

No task holds the whole model. Texts are dealt into blocks. Each block sends its distinct n-grams, with their counts
in its training texts, to shards of the hash space; a shard sums the counts over all blocks and answers each block
with the totals of just the n-grams it asked for. From these a block builds its part of the automaton, in which its
own texts take the very paths that they would take in the whole one, and walks them once from left to right.

A block sends at most FAN rows. Where there are more shards than that, a row goes to a range of shards, in which the
questions of FAN blocks are merged and then dealt to the range's shards; answers take the same way back. So rows grow
with the number of blocks and not with blocks times shards.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

ORDER = 3
MASS = (0.0, 300.0, 3.0, 1.0)
HELD_OUT = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20
FAN = 4096
LANE = 512
END = np.uint64(0xE2D)  # no hash of a word is as small but by a chance of 2 ** -52
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, vocabulary long"


def _ngrams(table: pa.Table, order: int):
    """Where texts begin (and the end); then for each length n, one after the other, the hash of the n-gram that ends at a token and the tokens at which one does. Each text has an end token."""
    word, rows = C.words(table["text"])
    word = np.insert(word, rows[1:], END)
    rows = rows + np.arange(len(rows))

    def each():
        left = np.arange(len(word), dtype=np.int32) - np.repeat(rows[:-1].astype(np.int32), np.diff(rows))  # tokens before it in its text
        yield word, np.arange(len(word), dtype=np.int32)
        before = word
        for n in range(2, order + 1):
            longer = np.zeros_like(word)
            longer[1:] = C.chain(before[:-1], word[1:])
            before = longer
            place = np.flatnonzero(left >= n - 1).astype(np.int32)
            yield longer[place], place

    return rows, each()


def _dealt(columns: list[tuple[np.ndarray, np.ndarray]], shards: int, parts: range) -> list[bytes]:
    """Packed keys with counts for each of these shards. One with nothing to ask is asked too: it tells its share of the training tokens and of the vocabulary."""
    cuts = [C.shard_cuts(keys, shards) for keys, _ in columns]
    return [C.pack_counted([(keys[c[k] : c[k + 1]], n[c[k] : c[k + 1]]) for (keys, n), c in zip(columns, cuts)]) for k in parts]


def _ask(ranges: int, order: int, held_out: int):
    def ask(table: pa.Table) -> pa.Table:
        rows, grams = _ngrams(table, order)
        learns = np.repeat(C.remainders(table["doc_id"].to_pylist(), held_out) != 0, np.diff(rows))
        columns = []
        for gram, place in grams:
            keys = C.distinct(gram)
            seen, n = C.distinct(gram[learns[place]], counts=True)
            counts = np.zeros(len(keys), np.int64)
            counts[np.searchsorted(keys, seen)] = n
            columns.append((keys, counts))
        parts = range(ranges)
        return pa.table({"block": pa.array([table["block"][0].as_py()] * len(parts), pa.int64()), "part": pa.array(parts, pa.int32()), "payload": pa.array(_dealt(columns, ranges, parts), pa.binary())})
    return ask


def _summed(asked: list[list[tuple[np.ndarray, np.ndarray]]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of one length over all that ask, each one's place among them, and their total counts."""
    keys, place = C.factorize(np.concatenate([x[n][0] for x in asked]))
    return keys, place, np.bincount(place, np.concatenate([x[n][1] for x in asked]).astype(float), len(keys)).astype(np.int64)


def _replies(totals: list[list[np.ndarray]], n_train: int, vocabulary: int) -> list[bytes]:
    """To each that asked: training tokens and vocabulary of these shards, and the totals of its n-grams in its order."""
    head = n_train.to_bytes(8, "little") + vocabulary.to_bytes(8, "little")
    return [head + C.squeeze(b"".join(C.planes(t) for t in each)) for each in totals]


def _split(place: np.ndarray, total: np.ndarray, asked: list, n: int) -> list[np.ndarray]:
    ends = np.cumsum([len(x[n][0]) for x in asked])
    return np.split(total[place], ends[:-1])


def _answer(order: int, who: str = "block"):
    def answer(table: pa.Table) -> pa.Table:
        """Totals over all that ask this shard."""
        asked = [C.unpack_counted(x, order) for x in table["payload"].to_pylist()]
        each, head = [], (0, 0)
        for n in range(order):
            keys, place, total = _summed(asked, n)
            if n == 0:
                head = int(total.sum()), int((total > 0).sum())
            each.append(_split(place, total, asked, n))
        return pa.table({who: table[who].cast(pa.int64()), "part": table["part"].cast(pa.int32()), "payload": pa.array(_replies([list(x) for x in zip(*each)], *head), pa.binary())})
    return answer


def _merge(order: int, ranges: int, sub: int):
    def merge(table: pa.Table) -> pa.Table:
        """The questions of a group of blocks to one range, merged and dealt to its shards."""
        asked = [C.unpack_counted(x, order) for x in table["payload"].to_pylist()]
        columns = []
        for n in range(order):
            keys, _, total = _summed(asked, n)
            columns.append((keys, total))
        parts = range(table["part"][0].as_py() * sub, (table["part"][0].as_py() + 1) * sub)
        return pa.table({"team": pa.array([table["team"][0].as_py()] * len(parts), pa.int64()), "part": pa.array(parts, pa.int32()), "payload": pa.array(_dealt(columns, ranges * sub, parts), pa.binary())})
    return merge


def _return(order: int, ranges: int, sub: int):
    def back(table: pa.Table, answers: pa.Table) -> pa.Table:
        """The answers to a group of blocks, dealt to each."""
        if not table.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "part": pa.array([], pa.int32()), "payload": pa.array([], pa.binary())})
        asked, part = [C.unpack_counted(x, order) for x in table["payload"].to_pylist()], table["part"][0].as_py()
        merged = [_summed(asked, n) for n in range(order)]
        totals, n_train, vocabulary = _totals([keys for keys, _, _ in merged], answers, ranges * sub)
        each = [_split(place, total, asked, n) for n, ((_, place, _), total) in enumerate(zip(merged, totals))]
        return pa.table({"block": table["block"].cast(pa.int64()), "part": pa.array([part] * table.num_rows, pa.int32()), "payload": pa.array(_replies([list(x) for x in zip(*each)], n_train, vocabulary), pa.binary())})
    return back


def _totals(keys: list[np.ndarray], answers: pa.Table, shards: int) -> tuple[list[np.ndarray], int, int]:
    """Totals of ascending keys of each length from the answers of their shards; and sums of the shards' training tokens and vocabularies."""
    got, n_train, vocabulary = {}, 0, 0
    for part, packed in zip(answers["shard" if "shard" in answers.column_names else "part"].to_pylist(), answers["payload"].to_pylist()):
        n_train, vocabulary = n_train + int.from_bytes(packed[:8], "little"), vocabulary + int.from_bytes(packed[8:16], "little")
        got[part] = [C.unsqueeze(packed[16:]), 0]
    totals = []
    for each in keys:
        cuts, found = C.shard_cuts(each, shards), []
        for part in sorted(got):
            values, got[part][1] = C.unplanes(got[part][0], int(cuts[part + 1] - cuts[part]), got[part][1])
            found.append(values)
        totals.append(np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64))
    return totals, n_train, vocabulary


class Automaton:
    """The part of the whole automaton that a block of texts can reach. Numbers of tokens, arcs and states of a block fit 32 bits.

    States are seen histories (0: the empty one). An arc leads from a history by one more token, that is, it is a seen
    n-gram: `weight` is its log-probability and `follow` the state it leads to. From the empty history there is an arc
    for every token. A state's failure arc leads to the history without its first token, at the cost of `backoff`.
    Arcs are held by number; `arc[n - 1][i]` is the arc of the n-gram that ends at token i (-1: there is none)."""

    def __init__(self, rows: np.ndarray, places: list[np.ndarray], ids: list[np.ndarray], totals: list[np.ndarray], floor: np.ndarray, mass: tuple):
        """ids: each n-gram's number among the distinct ones of its length; totals: their counts; floor: the probability of each distinct token with the empty history."""
        order, tokens = len(ids), int(rows[-1])
        fail, backoff, weight, follow = [np.zeros(1, np.int64)], [np.zeros(1)], [], []
        self.arc = []
        states, arcs, below = 1, 0, {}
        for n in range(1, order + 1):
            total, place, own = totals[n - 1], places[n - 1], ids[n - 1]
            one = np.zeros(len(total), np.int32)
            one[own] = place  # a place where each n-gram ends
            if n == 1:
                prob, suffix = floor, np.zeros(len(total), np.int64)
            else:
                history, shorter = below["at"][one - 1], below["at"][one]
                prob = (total + mass[n - 1] * below["prob"][shorter]) / (below["total"][history] + mass[n - 1])
                suffix = below["state"][shorter]
            state, seen = suffix.copy(), total > 0
            if n < order:
                state[seen] = states + np.arange(int(seen.sum()))
                states += int(seen.sum())
                fail.append(suffix[seen])
                backoff.append(np.log10(mass[n] / (total[seen] + mass[n])))
            at = np.full(tokens, -1, np.int32)
            at[place] = own
            has = at >= 0
            self.arc.append(np.where(has & (seen[at] | (n == 1)), at + np.int32(arcs), np.int32(-1)) if len(total) else at)
            arcs += len(total)
            weight.append(np.log10(prob))
            follow.append(state)
            below = {"at": at, "prob": prob, "total": total, "state": state}
        self.fail, self.backoff = np.concatenate(fail), np.concatenate(backoff)
        self.weight, self.follow = np.concatenate(weight), np.concatenate(follow)
        self.length = np.zeros(states, np.int8)  # of each history
        for s in range(1, order):
            longer = self.length[self.fail] == s - 1
            longer[0] = False
            self.length[longer] = s

    def step(self, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of the tokens at these places, and the states after them."""
        score, state = np.zeros(len(state)), state.copy()
        left = np.arange(len(state))
        while len(left):
            length = self.length[state[left]]
            arc = np.empty(len(left), np.int64)
            for n, of in enumerate(self.arc):
                here = length == n
                arc[here] = of[place[left[here]]]
            hit = arc >= 0
            done, miss = left[hit], left[~hit]
            score[done] += self.weight[arc[hit]]
            state[done] = self.follow[arc[hit]]
            score[miss] += self.backoff[state[miss]]
            state[miss] = self.fail[state[miss]]
            left = miss
        return score, state


def walk(auto: Automaton, rows: np.ndarray, order: int, lane: int = LANE) -> np.ndarray:
    """Score of each text in one traversal. Texts advance side by side; a long one is cut into lanes, and a lane first reads the order - 1 tokens before it, after which it is in the state that the whole text would have reached."""
    lengths = np.diff(rows)
    n_lanes = -(-lengths // lane)
    doc = np.repeat(np.arange(len(lengths)), n_lanes)
    start = rows[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n_lanes) - n_lanes, n_lanes)) * lane
    stop = np.minimum(start + lane, rows[1:][doc])
    warm = np.maximum(start - (order - 1), rows[:-1][doc])
    by = np.argsort(warm - stop, kind="stable")  # the longest first: those still running are a prefix
    doc, start, stop, warm = doc[by], start[by], stop[by], warm[by]
    state, total = np.zeros(len(doc), np.int64), np.zeros(len(doc))
    t = 0
    while running := int(np.searchsorted(warm - stop, -t, "left")):
        place = warm[:running] + t
        score, state[:running] = auto.step(state[:running], place)
        total[:running] += np.where(place >= start[:running], score, 0)
        t += 1
    return np.bincount(doc, total, len(lengths))


def _score(order: int, held_out: int, mass: tuple):
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _ARROW.empty_table()
        rows, grams = _ngrams(texts, order)
        keys, ids, places = [], [], []
        for gram, place in grams:
            key, own = C.factorize(gram)
            keys.append(key)
            ids.append(own.astype(np.int32))
            places.append(place)
        totals, n_train, vocabulary = _totals(keys, answers, answers.num_rows)  # every range answers
        del keys, grams
        totals = [t.astype(float) for t in totals]
        floor = (totals[0] + 0.1) / (n_train + 0.1 * (vocabulary + 1))
        auto = Automaton(rows, places, ids, totals, floor, mass)
        sums = lambda x: np.add.reduceat(x[ids[0]], rows[:-1])  # noqa: E731  every text has at least its end
        n = texts.num_rows
        return pa.table({
            "doc_id": texts["doc_id"].cast(pa.int64()), "held_out": C.remainders(texts["doc_id"].to_pylist(), held_out) == 0,
            "n_tokens": np.diff(rows), "n_known": sums((totals[0] > 0).astype(np.int64)), "train_tokens": np.full(n, n_train, np.int64),
            "base_score": sums(np.log10(floor)), "score": walk(auto, rows, order), "vocabulary": np.full(n, vocabulary, np.int64),
        })
    return score


_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("vocabulary", pa.int64())])


def _packed(block_bytes: int):
    """Blocks of texts as they are read, each compressed: (block, payload)."""
    def run(batches):
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            rows = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) + k], pa.int64()), pa.array([C.freeze(rows)], pa.binary())], ["block", "payload"])

        for b in C.slices(batches, most=block_bytes):
            n = len(C.utf8(b.column("text"))[0])
            if held and size + n > block_bytes:
                yield block()
                k, held, size = k + 1, [], 0
            held.append(b)
            size += n
        if held:
            yield block()
    return run


def _thawed(table: pa.Table) -> pa.Table:
    """The texts of a block's one packed row."""
    rows = C.thaw(table["payload"][0].as_py())
    return rows.append_column("block", pa.array([table["block"][0].as_py()] * rows.num_rows, pa.int64()))


def score_texts(docs: DataFrame, order: int = ORDER, mass: tuple = MASS, held_out: int = HELD_OUT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, fan: int = FAN) -> DataFrame:
    """Score every whole text of (doc_id, text) under a model of the texts whose crc32(doc_id as text) mod `held_out` is not 0.

    One row out for each row in. A null text is empty and has its end token alone; a null id counts as empty text in the
    crc and so is held out; repeated rows are scored each and learnt each; columns besides doc_id and text are ignored;
    an empty table gives no rows; a very long text is a block of its own size. Memory is that of one block and one shard,
    whatever the corpus. The table should come in the same order whenever it is read, as written tables do: its blocks
    are made where it is read, once, and a lost executor's are made again."""
    spark, total = docs.sparkSession, C.text_bytes(docs)
    blocks, shards = max(1, math.ceil(total / block_bytes)), max(1, math.ceil(total / shard_bytes))
    ranges, teams = min(shards, fan), math.ceil(blocks / fan)
    sub = -(-shards // ranges)
    n, m = C.parts(spark, total, 32 << 20), C.parts(spark, 3 * total, 64 << 20)
    ask, score = _ask(ranges, order, held_out), _score(order, held_out, mass)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_packed(block_bytes), "block long, payload binary").repartition(n, "block")
    asked = texts.groupBy("block").applyInArrow(C.lean(lambda table: ask(_thawed(table))), "block long, part int, payload binary")
    if sub == 1:
        answers = asked.repartition(m, "part").groupBy("part").applyInArrow(C.lean(_answer(order)), "block long, part int, payload binary")
    else:
        asked = asked.withColumn("team", F.pmod(F.xxhash64("block"), F.lit(teams))).repartition(m, "team", "part")
        merged = asked.groupBy("team", "part").applyInArrow(C.lean(_merge(order, ranges, sub)), "team long, part int, payload binary")
        found = merged.repartition(m, "part").groupBy("part").applyInArrow(C.lean(_answer(order, "team")), "team long, part int, payload binary")
        found = found.withColumnRenamed("part", "shard").withColumn("part", F.floor(F.col("shard") / sub).cast("int"))
        answers = asked.groupBy("team", "part").cogroup(found.groupBy("team", "part")).applyInArrow(C.lean(_return(order, ranges, sub)), "block long, part int, payload binary")
    return texts.groupBy("block").cogroup(answers.repartition(n, "block").groupBy("block")).applyInArrow(C.lean(lambda table, got: score(_thawed(table), got) if table.num_rows else _ARROW.empty_table()), SCHEMA)
