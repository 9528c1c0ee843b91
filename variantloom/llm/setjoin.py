"""N-gram Jaccard join with set-relation skipping.

A text's set is its distinct word shingles. Two sets link when 100 * intersection >= percent * union, that is, when
(100 + percent) * intersection >= percent * (|x| + |y|). In any order of shingles, two such sets share one of the first
n - ceil(percent * n / 100) + 1 of each (the prefix). The order here is rarest first, by counts over all texts.

1. Blocks of texts ask shards of the hash space how many sets hold each of their shingles.
2. A block orders each set and files its prefix, without shingles that no other set holds. Sets that file nothing have
   no partner. Equal sets are one set from here on.
3. Shards of the index join sets that share a prefix shingle and may fit in size to families.
4. Each family (in bounded pieces) is joined exactly: lists of the prefix index are skipped by blocks of positions and
   sizes, and a set that is much like one already answered derives its answers from that one's by the few shingles in
   which the two differ. A set is only asked while some set of fitting size isn't yet in its component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SHINGLE = 3
PERCENT = 90
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 24 << 20
FAMILY_SHINGLES = 3_000_000
_OUT = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("shard", pa.int32()), ("payload", pa.binary())])
OUT = "kind int, doc_id long, row_key long, sid long, n long, shard int, payload binary"


def prefix(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def least(percent: int) -> int:
    """The size of the smallest set that can link with a different one: one with one shingle more."""
    return -(-percent // (100 - percent))


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct hashes; each row's members as places among them, row by row; where each row's begin (and the end)."""
    word, rows = C.words(texts)
    n = np.diff(rows)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(word)) - np.repeat(rows[:-1], n)
    gram = word
    for _ in range(k - 1):
        longer = np.zeros_like(word)
        longer[1:] = C.chain(gram[:-1], word[1:])
        gram = longer
    whole = (n[row] < k) & (at == n[row] - 1)  # the last word of a short text stands for all of it
    for j in range(1, k):
        short = np.flatnonzero(whole & (n[row] == j))
        value = C.mix(word[short - j + 1] + C.U64(j))
        for i in range(j - 1, 0, -1):
            value = C.chain(value, word[short - i + 1])
        gram[short] = value
    used = (at >= k - 1) | whole
    keys, place = C.factorize(gram[used])
    both = C.distinct(row[used] * max(1, len(keys)) + place)
    return keys, both % max(1, len(keys)), np.searchsorted(both, np.arange(len(n) + 1) * max(1, len(keys)))


def _signed(x) -> np.ndarray:
    return np.asarray(x, C.U64).view(np.int64)


def _signatures(keys: np.ndarray, members: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's 64-bit signature (0: an empty set), and the first row of each signature that isn't empty."""
    raw = keys[members]
    sid = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b].tobytes()) if b > a else 0 for a, b in zip(rows.tolist(), rows[1:].tolist())), C.U64, len(rows) - 1)
    distinct, first = np.unique(sid, return_index=True)
    return sid, first[distinct != 0]


def _ask(shards: int, k: int):
    def ask(table: pa.Table) -> pa.Table:
        keys, members, rows = shingle_sets(table["text"], k)
        _, first = _signatures(keys, members, rows)
        count = np.bincount(members[C.ragged(rows[first], np.diff(rows)[first])], minlength=len(keys))
        cuts = C.shard_cuts(keys, shards)
        some = np.flatnonzero(np.diff(cuts)).tolist()  # no rows for shards about which there is nothing to ask: rows grow with shingles, not with blocks times shards
        return pa.table({"shard": pa.array(some, pa.int32()), "block": pa.array([table["block"][0].as_py()] * len(some), pa.int32()),
                         "payload": pa.array([C.pack_sorted(keys[cuts[k] : cuts[k + 1]], count[cuts[k] : cuts[k + 1]]) for k in some], pa.binary())})
    return ask


def _answer(table: pa.Table) -> pa.Table:
    """For each shingle a block asked about, the number of bits of the count of sets that hold it: 1 means no other set does."""
    asked = [C.unpack_sorted(x, 1)[0] for x in table["payload"].to_pylist()]
    keys, place = C.factorize(np.concatenate([k for k, _ in asked]))
    total = np.bincount(place, np.concatenate([n for _, n in asked]).astype(float), len(keys))
    bits = (np.floor(np.log2(np.maximum(total, 1))) + 1).astype(np.uint8)
    out, at = [], 0
    for k, _ in asked:
        out.append(bits[place[at : at + len(k)]].tobytes())
        at += len(k)
    return pa.table({"block": table["block"].cast(pa.int32()), "shard": table["shard"].cast(pa.int32()), "payload": pa.array(out, pa.binary())})


def _file(shards: int, k: int, percent: int):
    def file(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _OUT.empty_table()
        keys, members, rows = shingle_sets(texts["text"], k)
        sid, first = _signatures(keys, members, rows)
        size = np.diff(rows)
        got = b"".join(x for _, x in sorted(zip(answers["shard"].to_pylist(), answers["payload"].to_pylist())))
        bits = np.frombuffer(got, np.uint8).astype(np.int64)
        first = first[size[first] >= least(percent)]
        n = size[first]
        # each set rarest first: one sort of (set, bits, hash)
        place = members[C.ragged(rows[first], n)]
        u = max(1, len(keys))
        order = np.sort((np.repeat(np.arange(len(first)), n) * 64 + bits[place]) * u + place)
        place, owner = order % u, order // u // 64
        begin = np.cumsum(n) - n
        pos = np.arange(len(place)) - begin[owner]
        filed = (pos < prefix(n, percent)[owner]) & (bits[place] > 1)
        token, who, where = keys[place[filed]], owner[filed], pos[filed]
        by = np.argsort(token, kind="stable")
        token, who, where = token[by], who[by], where[by]
        cuts = C.shard_cuts(token, shards)
        some = np.flatnonzero(np.diff(cuts))
        postings = [C.pack_sorted(token[a:b], sid[first][who[a:b]], n[who[a:b]], where[a:b]) for a, b in zip(cuts[some].tolist(), cuts[some + 1].tolist())]
        used = np.unique(who)
        sets = [keys[place[begin[i] : begin[i] + n[i]]].tobytes() for i in used.tolist()]
        d, s, p = texts.num_rows, len(used), len(some)
        return pa.table({
            "kind": np.repeat(np.array([0, 1, 2], np.int32), [d, s, p]),
            "doc_id": pa.concat_arrays([texts["doc_id"].combine_chunks().cast(pa.int64()), pa.nulls(s + p, pa.int64())]),
            "row_key": pa.concat_arrays([texts["row_key"].combine_chunks().cast(pa.int64()), pa.nulls(s + p, pa.int64())]),
            "sid": np.concatenate([_signed(sid), _signed(sid[first[used]]), np.zeros(p, np.int64)]),
            "n": np.concatenate([size, n[used], np.zeros(p, np.int64)]).astype(np.int64),
            "shard": np.concatenate([np.zeros(d + s, np.int32), some.astype(np.int32)]),
            "payload": pa.concat_arrays([pa.nulls(d, pa.binary()), pa.array(sets, pa.binary()), pa.array(postings, pa.binary())]),
        }, schema=_OUT)
    return file


def _meet(percent: int):
    def meet(table: pa.Table) -> pa.Table:
        """Links (a, b) that tie together all sets which share a filed shingle and may fit in size: in a list ordered by size, each to the first, anew wherever a size is out of the last one's reach."""
        token, sid, n, pos = (np.concatenate(x) for x in zip(*(C.unpack_sorted(p, 3)[0] for p in table["payload"].to_pylist())))
        by = np.lexsort((sid, n, token))
        token, sid, n, pos = token[by], sid[by], n[by].astype(np.int64), pos[by].astype(np.int64)
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
        token, sid, n, pos = token[fresh], sid[fresh], n[fresh], pos[fresh]
        head = np.ones(len(token), bool)
        head[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:])
        starts = np.flatnonzero(head)
        lengths = np.diff(starts, append=len(token))
        two = starts[lengths == 2]  # a pair: the places of the shingle bound what the sets can share
        most = np.minimum(pos[two], pos[two + 1]) + np.minimum(n[two] - pos[two], n[two + 1] - pos[two + 1]) if len(two) else two
        apart = two[(100 + percent) * most < percent * (n[two] + n[two + 1])] if len(two) else two
        head[apart + 1] = True
        starts = np.flatnonzero(head)
        first = np.repeat(starts, np.diff(starts, append=len(token)))
        pairs = np.stack([sid[first], sid], 1)[~head]
        pairs = np.unique(pairs.view("u8,u8")).view(C.U64).reshape(-1, 2) if len(pairs) else pairs
        return pa.table({"a": _signed(pairs[:, 0].copy()), "b": _signed(pairs[:, 1].copy())})
    return meet


class Family:
    """Sets that may link, joined exactly. `root` becomes each set's component."""

    BLOCK = 32

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent = percent
        self.n = np.fromiter(map(len, sets), np.int64, len(sets))
        self.order = np.argsort(self.n, kind="stable")
        self.n = self.n[self.order]
        sets = [sets[i] for i in self.order.tolist()]
        _, self.token = C.factorize(np.concatenate(sets))
        self.begin = np.concatenate([[0], np.cumsum(self.n)])
        owner = np.repeat(np.arange(len(sets)), self.n)
        by = np.argsort(self.token, kind="stable")
        self.lists = owner[by]  # of each shingle, the sets that hold it
        self.list_at = np.searchsorted(self.token[by], np.arange(int(self.token.max()) + 2))
        pos = np.arange(len(owner)) - self.begin[owner]
        head = np.flatnonzero(pos < prefix(self.n, percent)[owner])
        t, p, o = self.token[head], pos[head], owner[head]
        by = np.lexsort((p, t))  # the prefix index: lists ordered by position
        self.p_set, self.p_pos, t = o[by], p[by], t[by]
        self.p_at = np.searchsorted(t, np.arange(int(self.token.max()) + 2))
        # a block never holds entries of two shingles
        lengths = np.diff(self.p_at)
        blocks = -(-lengths // self.BLOCK)
        self.b_first = np.repeat(self.p_at[:-1], blocks) + (np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * self.BLOCK
        self.b_at = np.concatenate([[0], np.cumsum(blocks)])
        self.b_last = np.minimum(self.b_first + self.BLOCK, np.repeat(self.p_at[1:], blocks))
        size = self.n[self.p_set]
        self.b_small, self.b_large = np.minimum.reduceat(size, self.b_first), np.maximum.reduceat(size, self.b_first)
        self.b_rest = np.maximum.reduceat(size - self.p_pos, self.b_first)
        self.b_pos = np.maximum.reduceat(self.p_pos, self.b_first)
        self.label = np.arange(len(sets))
        self.inside: dict[int, np.ndarray] = {}
        self.skipped = self.derived = self.asked = 0

    def of(self, x: int) -> np.ndarray:
        return self.token[self.begin[x] : self.begin[x + 1]]

    def probe(self, x: int, places: np.ndarray, slack: int) -> np.ndarray:
        """Sets that share one of x's prefix shingles at these places. Blocks in which no set can fit, by size or by what position leaves, are skipped; slack: by how much a set like x may exceed x."""
        t, n, p = self.of(x)[places], int(self.n[x]), self.percent
        count = self.b_at[t + 1] - self.b_at[t]
        block = C.ragged(self.b_at[t], count)
        at = np.repeat(places, count)
        need = (p * (n + self.b_small[block]) + 99 + p) // (100 + p) - slack
        most = np.minimum(at, self.b_pos[block]) + np.minimum(n - at, self.b_rest[block])
        fits = (most >= need) & (100 * (self.b_large[block] + slack) >= p * (n - slack)) & (p * (self.b_small[block] - slack) <= 100 * (n + slack))
        self.skipped += int((~fits).sum())
        block = block[fits]
        return np.unique(self.p_set[C.ragged(self.b_first[block], self.b_last[block] - self.b_first[block])])

    def shared(self, x: int, others: np.ndarray) -> np.ndarray:
        """Exact intersections with other sets."""
        if not len(others):
            return np.zeros(0, np.int64)
        mark = np.zeros(int(self.list_at.size), np.int64)
        mark[self.of(x)] = 1
        n = self.n[others]
        return np.add.reduceat(mark[self.token[C.ragged(self.begin[others], n)]], np.cumsum(n) - n)

    def links(self, x: int, others: np.ndarray, inter: np.ndarray) -> np.ndarray:
        both = self.n[x] + self.n[others]
        return others[(100 * inter >= self.percent * (both - inter)) & (others != x)]

    def join(self, x: int, others: np.ndarray) -> None:
        for y in others[self.label[others] != self.label[x]].tolist():
            a, b = int(self.label[x]), int(self.label[y])
            if a == b:
                continue
            one, two = (self.inside.pop(k, None) for k in (a, b))
            one = np.array([a]) if one is None else one
            two = np.array([b]) if two is None else two
            if len(one) < len(two):
                a, b, one, two = b, a, two, one
            self.label[two] = a
            self.inside[a] = np.concatenate([one, two])

    def settled(self, x: int) -> bool:
        """No set of fitting size is outside x's component."""
        low, high = np.searchsorted(self.n, [(self.percent * self.n[x] + 99) // 100, 100 * self.n[x] // self.percent + 1])
        own = self.inside.get(int(self.label[x]))
        return (1 if own is None else len(own)) >= high - low and bool((self.label[low:high] == self.label[x]).all())

    def run(self) -> np.ndarray:
        done = np.zeros(len(self.n), bool)
        for r in range(len(self.n)):
            if done[r] or self.settled(r):
                continue
            self.asked += 1
            slack = (100 - self.percent) * int(self.n[r]) // self.percent + 2  # what a linked set may hold besides r's shingles
            known = self.probe(r, np.arange(prefix(int(self.n[r]), self.percent)), slack)
            inter = self.shared(r, known)
            like = self.links(r, known, inter)
            self.join(r, like)
            done[r] = True
            for x in like[~done[like]].tolist():
                done[x] = True
                if not self.settled(x):
                    self.derived += 1
                    self.derive(x, r, known, inter)
        out = np.empty(len(self.n), np.int64)
        out[self.order] = self.order[self.label]
        return out

    def derive(self, x: int, r: int, known: np.ndarray, inter: np.ndarray) -> None:
        """x's links from r's intersections: corrected by the lists of the shingles in which the two differ, and beside those only sets that share a prefix shingle of x that isn't one of r's."""
        mine, theirs = self.of(x), self.of(r)
        plus, minus = np.setdiff1d(mine, theirs, True), np.setdiff1d(theirs, mine, True)
        change = np.zeros(len(self.n), np.int64)
        for tokens, by in ((plus, 1), (minus, -1)):
            np.add.at(change, self.lists[C.ragged(self.list_at[tokens], self.list_at[tokens + 1] - self.list_at[tokens])], by)
        self.join(x, self.links(x, known, inter + change[known]))
        head = mine[: prefix(len(mine), self.percent)]
        new = self.probe(x, np.flatnonzero(~np.isin(head, theirs[: prefix(len(theirs), self.percent)])), 0)
        new = np.setdiff1d(new, known, True)
        self.join(x, self.links(x, new, self.shared(x, new)))


def _link(percent: int):
    def link(table: pa.Table) -> pa.Table:
        sid, first = np.unique(table["sid"].to_numpy(), return_index=True)
        payload = table["payload"].to_pylist()
        root = Family([np.frombuffer(payload[i], C.U64) for i in first.tolist()], percent).run()
        low = np.full(len(sid), np.iinfo(np.int64).max)
        np.minimum.at(low, root, sid)
        linked = np.bincount(root, minlength=len(sid))[root] > 1
        return pa.table({"a": sid[linked], "b": low[root][linked]})
    return link


def link_texts(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, family_shingles: int = FAMILY_SHINGLES) -> DataFrame:
    """One row for each row of (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    A null or empty text has an empty set and is linked with nothing. Rows with equal sets are linked; repeated rows too.
    Null ids take part but name no component (it is null where no other id is in it). Other columns are not read; a very
    long text is a block of its own size; an empty table gives no rows. A family of more shingles than `family_shingles` is
    joined in pieces."""
    return _linked(docs, k, percent, block_bytes, shard_bytes, family_shingles).select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"))


def _linked(docs: DataFrame, k: int, percent: int, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, family_shingles: int = FAMILY_SHINGLES) -> DataFrame:
    """(doc_id, row_key, n_shingles, first): first is the component's first row, by id (null last) and key."""
    if not 0 < percent < 100:
        raise ValueError(f"percent must be between 0 and 100: {percent}")
    spark, total = docs.sparkSession, C.text_bytes(docs)
    blocks, shards = max(1, math.ceil(total / block_bytes)), max(1, math.ceil(total / shard_bytes))
    n = C.parts(spark, total, 32 << 20)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block")).repartition(n, "block")
    asked = texts.groupBy("block").applyInArrow(C.lean(_ask(shards, k)), "shard int, block int, payload binary")
    answers = asked.groupBy("shard").applyInArrow(C.lean(_answer), "block int, shard int, payload binary")
    filed = C.stash(texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(C.lean(_file(shards, k, percent)), OUT), "filed", by="kind")
    ids = filed.where("kind = 0").select("doc_id", "row_key", "sid", F.col("n").alias("n_shingles"))
    met = filed.where("kind = 2").groupBy("shard").applyInArrow(C.lean(_meet(percent)), "a long, b long")
    families = C.stash(components(met).withColumnsRenamed({"node": "sid", "root": "family"}), "families")
    sets = filed.where("kind = 1").groupBy("sid").agg(F.first("n").alias("n"), F.first("payload").alias("payload"))
    member = C.stash(sets.join(families, "sid"), "members")
    pieces = member.groupBy("family").agg(F.ceil(F.sum("n") / family_shingles).cast("int").alias("pieces"))
    split = C.stash(pieces.where("pieces > 1"), "pieces")
    many = split.count() > 0
    if many:
        member = C.salted_join(member, split, "family", "sid").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        own = F.pmod(F.xxhash64("sid"), F.col("pieces")).cast("int")
        member = member.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("family", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "sid", "payload")
    else:
        member = member.select("family", F.lit(0).alias("x"), F.lit(0).alias("y"), "sid", "payload")
    found = member.groupBy("family", "x", "y").applyInArrow(_link(percent), "a long, b long")
    roots = components(found) if many else found.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = C.stash(roots.withColumnRenamed("node", "sid"), "roots")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    each = C.stash(ids.where("n_shingles > 0").groupBy("sid").agg(F.min(row).alias("least")), "sets").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = each.groupBy("root").agg(F.min("least").alias("first"))
    by_set = C.salted_join(each.select("sid", "root"), named, "root", "sid", how="inner").select("sid", "first")
    linked = C.salted_join(ids.where("n_shingles > 0"), by_set, "sid", "row_key").select("doc_id", "row_key", "n_shingles", "first")
    return linked.unionByName(ids.where("n_shingles = 0").select("doc_id", "row_key", "n_shingles", row.alias("first")))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked texts, with all its columns, whatever these are called: the one with the smallest doc_id (null last).

    Rows are told apart by id and text, so an id that several texts share loses none that isn't linked. Of rows alike in
    both one stays. Texts without a word (null and empty ones) are linked with nothing and stay, each row of them. An empty
    table gives an empty one."""
    doc_id, key, times = C.fresh(docs.columns, "id", "key", "times")
    rows = C.stash(_linked(docs, k, percent).where("n_shingles > 0"), "linked")
    mine = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key"))
    side = lambda df: df.select(F.col("doc_id").alias(doc_id), F.col("row_key").alias(key))
    here = (C.column("doc_id").cast("long").eqNullSafe(F.col(doc_id))) & (F.xxhash64("text") == F.col(key))
    kept = docs.join(side(rows.where(~mine).distinct()), here, "left_anti")
    repeated = C.stash(side(rows.where(mine).groupBy("doc_id", "row_key").agg(F.count("*").alias("n")).where("n > 1")), "repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, here, "left_semi").withColumn(key, F.xxhash64("text"))
    return kept.join(repeated, here, "left_anti").unionByName(once.dropDuplicates(["doc_id", key]).drop(key))
