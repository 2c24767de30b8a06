"""Conversation prefix trie in balanced parentheses, shard by shard. [operator 12]

Conversations are sequences of turns. Every distinct sequence becomes a key, the digests
of its turns one behind the other; sorted keys are the trie in preorder, as a prefix sorts
before what goes on from it. Key ranges are shards of bounded size, and a shard writes its
part of the trie as balanced parentheses. Then

* ``findclose`` delimits a subtree: the first place behind a node where the excess falls
  below the node's own, found in its block or through a tree of block minima;
* rank counts the leaf pairs ``()`` inside it;
* cumulative arrays over the preorder give the members and the saved words inside it.

The spine, the path to the last key before a shard's border, is shared with the next shard.
A shard knows from the neighbouring keys how many of its nodes are shared. It counts a
shared node's children and words only where the node comes first, and does not take a key
that the next shard goes on from for a leaf. So each thing is counted once, and merging
the shared nodes of all shards is a sum per node. No node's members are brought together:
the ids of those that end at a node are hashed as they stream by, in parts of 65,536 ids.

Cases: turns are ordered by turn, null first; turns of the same number stand in the order
of their digests. A null role or text is empty. Rows with a null conversation id belong to no conversation and are left out.
Repeated rows are turns of their own. A conversation may have no turns left: it ends at
the root. Texts may be of any length; only their digests travel. All turns of one
conversation meet in one task, as digests of 16 bytes. An empty table has no nodes, not
even a root. Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import join_keyed, saved, ship, words_of

DIGEST = 16
# Rebuilt turns that a shard should hold.
SHARD_TURNS = 250_000
PART_BITS = 16
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Fixed values of the contract: conversations of a family, and how many first turns they may share.
FAMILY = 20
HEADS = 4


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``(conv, at, digest, words)``: the turns of each conversation in order, from 1."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("conv is not null")
    # The size of the role keeps it apart from the text.
    whole = F.concat_ws(":", F.octet_length("role"), F.col("role"), F.col("text"))
    rows = rows.select("conv", "turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
                       F.size(words_of(F.col("text"))).alias("words"))
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv", F.row_number().over(order).alias("at"), "digest", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv, key, words)``: the first ``h`` turns of the family's first one, then the own ones after ``h``."""
    base = F.col("conv") - F.col("conv") % FAMILY
    h = (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int")
    own = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("own")).select(
        "conv", "own", base.alias("base"), h.alias("h"))
    heads = turns.where((F.col("at") < HEADS) & (F.col("conv") == base)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", "words"))).alias("heads"))
    none = F.array().cast(heads.schema["heads"].dataType)
    both = own.join(heads, "base", "left").withColumn("heads", F.coalesce("heads", none))
    turns = F.concat(F.slice("heads", F.lit(1), F.col("h")), F.filter("own", lambda t: t["at"] > F.col("h")))
    both = both.select("conv", turns.alias("turns"))
    empty = F.lit(b"")
    return both.select("conv", F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")), empty)
                       .alias("key"), F.col("turns.words").alias("words"))


def sequences(conversations: DataFrame) -> DataFrame:
    """``(key, part, n, ids, least, words)``: distinct sequences, with up to 65,536 of their conversations.

    ``ids`` are decimal, in order and joined by commas.
    """
    part = F.shiftright("conv", PART_BITS).alias("part")
    return conversations.groupBy("key", part).agg(
        F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"),
        F.min("conv").alias("least"), F.any_value("words").alias("words"))


def sharded(parts: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``(shard, key, n, least, ends, words)``: a row per sequence, in key order inside its shard."""
    ship(parts.sparkSession)
    parts = saved(parts)
    total = parts.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    ranged = parts.repartitionByRange(-(-total // shard_turns) or 1, "key").sortWithinPartitions("key", "part")

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        now = None
        for batch in batches:
            done = []
            for key, n, ids, least, words in zip(*(batch[c] for c in ("key", "n", "ids", "least", "words"))):
                key = bytes(key)
                if now is not None and now[0] == key:
                    now[1] += n
                    now[2] = min(now[2], least)
                    now[3].update(("," + ids).encode())
                else:
                    if now is not None:
                        done.append((*now[:3], now[3].hexdigest(), now[4]))
                    now = [key, n, least, hashlib.sha256(ids.encode()), words]
            yield pd.DataFrame(done, columns=["key", "n", "least", "ends", "words"])
        if now is not None:
            yield pd.DataFrame([(*now[:3], now[3].hexdigest(), now[4])], columns=["key", "n", "least", "ends", "words"])

    rows = ranged.select("key", "n", "ids", "least", "words").mapInPandas(
        work, "key binary, n long, least long, ends string, words array<int>")
    return saved(rows.withColumn("shard", F.spark_partition_id()))


class Parentheses:
    """Balanced parentheses with range min-max blocks over their excess."""

    def __init__(self, opens):
        import numpy as np

        self.opens = opens
        step = np.where(opens, 1, -1)
        self.excess = np.cumsum(step)
        n_blocks = max(1, -(-len(opens) // BLOCK))
        padded = np.full(n_blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(opens)] = self.excess
        self.blocks = padded.reshape(n_blocks, BLOCK)
        # Block minima, then minima of two, up to the root.
        self.minima = [self.blocks.min(axis=1)]
        while len(self.minima[-1]) > 1:
            low = self.minima[-1]
            low = np.append(low, np.iinfo(np.int64).max) if len(low) % 2 else low
            self.minima.append(low.reshape(-1, 2).min(axis=1))

    def find_close(self, at):
        """For every opening parenthesis in ``at`` the place of the one that closes it."""
        import numpy as np

        goal = self.excess[at] - 1
        out = np.full(len(at), -1, dtype=np.int64)
        block = at // BLOCK
        todo = np.arange(len(at))
        for start in range(0, len(at), 1 << 14):
            part = todo[start:start + (1 << 14)]
            found = (self.blocks[block[part]] <= goal[part, None]) & (np.arange(BLOCK) > (at[part] % BLOCK)[:, None])
            has = found.any(axis=1)
            out[part[has]] = block[part[has]] * BLOCK + found[has].argmax(axis=1)
        # The others: up the tree until the right neighbour falls low enough, then down to its block.
        left = np.flatnonzero(out < 0)
        node, level, at_level = block[left].copy(), 0, left
        falls = np.full(len(at), -1, dtype=np.int64)
        for level in range(len(self.minima)):
            if not len(at_level):
                break
            low = self.minima[level]
            right = node + 1
            fits = (node % 2 == 0) & (right < len(low))
            fits[fits] = low[right[fits]] <= goal[at_level[fits]]
            down, who = right[fits], at_level[fits]
            for below in range(level - 1, -1, -1):
                low, down = self.minima[below], down * 2
                down = np.where(low[down] <= goal[who], down, down + 1)
            falls[who] = down
            node, at_level = node[~fits] // 2, at_level[~fits]
        for start in range(0, len(left), 1 << 14):
            part = left[start:start + (1 << 14)]
            low = self.blocks[falls[part]] <= goal[part, None]
            out[part] = falls[part] * BLOCK + low.argmax(axis=1)
        return out

    def leaf_pairs(self):
        """``rank[i]``: the number of pairs ``()`` that start before place ``i``."""
        import numpy as np

        pair = self.opens[:-1] & ~self.opens[1:]
        return np.concatenate([[0], np.cumsum(pair), [pair.sum()]])


def shard_nodes(keys: list[bytes], n, least, ends: list[str], words: list, before: int, after: int) -> dict:
    """The nodes of one shard, from its sorted keys, as columns.

    ``before`` and ``after`` tell how many turns the first key shares with the last one of
    the shard before, and the last key with the first one of the shard behind; -1 where
    there is none.
    """
    import numpy as np

    size = np.array([len(k) // DIGEST for k in keys], dtype=np.int64)
    common = np.zeros(len(keys), dtype=np.int64)
    for i in range(1, len(keys)):
        common[i] = _shared_turns(keys[i - 1], keys[i])
    # New nodes of a key, in preorder behind the root; the root itself comes first.
    fresh = size - common
    owner = np.concatenate([[0], np.repeat(np.arange(len(keys)), fresh)])
    depth = np.concatenate([[0], np.arange(fresh.sum()) - np.repeat(np.cumsum(fresh) - fresh, fresh)
                            + np.repeat(common, fresh) + 1])
    n_nodes = len(owner)
    first_of = 1 + np.cumsum(fresh) - fresh
    # The node where a key ends: its last new one, or the root for the key without turns.
    end = np.where(size > 0, first_of + fresh - 1, 0)

    # Before its new nodes a key closes what the last one had beyond the common part.
    opens = np.zeros(2 * n_nodes, dtype=bool)
    closed = np.concatenate([[0], size[:-1] - common[1:]])
    place = np.arange(n_nodes) + np.concatenate([[0], np.repeat(np.cumsum(closed), fresh)])
    opens[place] = True
    tree = Parentheses(opens)
    close = tree.find_close(place)
    last = np.arange(n_nodes) + (close - place + 1) // 2

    goes_on = after >= size[-1]
    rank = tree.leaf_pairs()
    leaves = rank[close] - rank[place]
    # The last key's pair is no leaf where the next shard goes on from it.
    if goes_on:
        leaves -= (place <= place[end[-1]]) & (close >= place[end[-1]])

    at_end = np.zeros(n_nodes, dtype=np.int64)
    at_end[end] = n
    members = np.concatenate([[0], np.cumsum(at_end)])
    n_convs = members[last] - members[:n_nodes]
    # The smallest member of a node is that of its range of keys; the ranges of a depth are apart.
    bounds = np.column_stack([owner, np.searchsorted(end, last)])
    smallest = np.minimum.reduceat(np.append(least, np.iinfo(np.int64).max), bounds.ravel())[::2]

    own_words = np.concatenate([[0], *(np.asarray(w, dtype=np.int64)[c:] for w, c in zip(words, common))]).astype(np.int64)
    on_first = (owner == 0) & (depth <= before)
    on_last = (np.arange(n_nodes) <= end[-1]) & (last > end[-1]) & (depth <= after)
    mine = ~on_first
    # A node's members times its words, once a shard; its words once in all, where it comes first.
    gain = np.concatenate([[0], np.cumsum(n_convs * own_words - mine * own_words)])
    saved_words = gain[last] - gain[:n_nodes]

    # A node's parent: the last node one level higher before it.
    order = np.argsort(depth, kind="stable")
    level = depth[order] * n_nodes + order
    want = np.searchsorted(level, (depth - 1) * n_nodes + np.arange(n_nodes)) - 1
    parent = np.where(depth > 0, order[np.maximum(want, 0)], -1)
    children = np.bincount(parent[1:][mine[1:]], minlength=n_nodes) if n_nodes > 1 else np.zeros(n_nodes, dtype=np.int64)

    digest = np.full(n_nodes, NO_ENDS, dtype=object)
    digest[end] = ends
    shared = on_first | on_last
    first_names, last_names = _names(keys[0], before), _names(keys[-1], after)
    names: list[bytes | None] = [None] * n_nodes
    for i in np.flatnonzero(shared):
        names[i] = (first_names if on_first[i] else last_names)[depth[i]]
    up = np.maximum(parent, 0)
    return {
        "node": names, "shared": shared, "conv_id": smallest, "depth": depth,
        "parent": [names[p] if p >= 0 else None for p in parent],
        "parent_conv_id": [int(smallest[u]) if p >= 0 and not shared[p] else None for p, u in zip(parent, up)],
        "n_convs": n_convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved_words,
        "ends_sha256": digest,
    }


def _names(key: bytes, upto: int) -> list[bytes]:
    """A name for each of the first ``upto`` nodes below the root on the path of a key, and for the root."""
    path = hashlib.blake2b(digest_size=16)
    names = [path.digest()]
    for d in range(upto):
        path.update(key[d * DIGEST:(d + 1) * DIGEST])
        names.append(path.digest())
    return names


def _shared_turns(a: bytes, b: bytes) -> int:
    """How many whole turns two keys have in common from the start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle * DIGEST] == b[:middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


NODES = ("node binary, shared boolean, conv_id long, depth long, parent binary, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def borders(shards: DataFrame) -> DataFrame:
    """``(shard, before, after)``: how many turns a shard shares with its neighbours, a row per shard."""
    ends = shards.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    turn = Window.orderBy("shard")
    ends = ends.select("shard", "first", "last", F.lag("last").over(turn).alias("previous"), F.lead("first").over(turn).alias("next"))

    def work(batches: Iterator) -> Iterator:
        for frame in batches:
            for a, b, name in (("previous", "first", "before"), ("last", "next", "after")):
                frame[name] = [-1 if x is None or y is None else _shared_turns(bytes(x), bytes(y))
                               for x, y in zip(frame[a], frame[b])]
            yield frame[["shard", "before", "after"]]

    return ends.mapInPandas(work, "shard int, before long, after long")


def trie(shards: DataFrame) -> DataFrame:
    """The nodes of all shards, those that shards share more than once, as partial counts."""
    rows = shards.join(F.broadcast(saved(borders(shards))), "shard")

    def work(batches: Iterator) -> Iterator:
        import pandas as pd

        got = [b for b in batches if len(b)]
        if not got:
            return
        frame = pd.concat(got, ignore_index=True)
        yield pd.DataFrame(shard_nodes(
            [bytes(k) for k in frame["key"]], frame["n"].to_numpy(), frame["least"].to_numpy(), list(frame["ends"]),
            list(frame["words"]), int(frame["before"][0]), int(frame["after"][0])))

    return rows.mapInPandas(work, NODES)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations, see ``COLUMNS``."""
    shards = sharded(sequences(rebuilt(turn_rows(conversations))), shard_turns)
    nodes = saved(trie(shards))
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ends = F.coalesce(F.min(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS))
    spine = saved(nodes.where("shared").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"),
        F.max("parent").alias("parent"), F.max("parent_conv_id").alias("parent_conv_id"), *total,
        ends.alias("ends_sha256")))
    every = saved(nodes.where("not shared").drop("shared", "node").unionByName(spine.drop("node")))
    told = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"),
                        F.greatest("n_children", F.lit(1)).alias("rows"))
    below = join_keyed(every.where("parent is not null"), told, ["parent"], "rows").withColumn("parent_conv_id", F.col("of_parent"))
    return every.where("parent is null").select(*COLUMNS).unionByName(below.select(*COLUMNS))
