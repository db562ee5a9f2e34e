"""Prefix trie of conversations whose heads come from other conversations.

A conversation is rebuilt as the first h turns of its base conversation and its
own turns after the first h.  No rebuilt text is made: a sequence of turns is an
element of a monoid, the map v -> v * R^n + f modulo 2^127 - 1 with n its length
and f its fingerprint, and sequences are joined by composing maps.  With the
prefix products of every conversation known, the product of the base's head and
the own suffix up to any turn is f + delta * R^k: one delta a conversation.

1. Turns get a digest of their role and text, are sorted by conversation and turn
   over all tasks, and are folded where they lie; a conversation that goes on in
   the next task gets the product of its earlier part (two a task at most).
2. Each conversation meets the head (``most`` turns at most) of its base, and
   gives a row for every prefix: depth, fingerprint, and the digest of its last
   turn as the reference to that stored turn.
3. Prefixes group by (depth, fingerprint) into nodes.  This is verified: turns
   of one digest have one role and text (counted over the texts themselves), and
   members of a node end in one digest.  As the maps can be undone, equal
   fingerprints and last digests have equal parents, so that a group's sequences
   are equal from the root on.  If either fails, all is done anew with another R
   and other digests.
4. A node belongs to its smallest member.  What a conversation owns is the end of
   its path, so sums over subtrees need no walk over the tree: each member adds
   what it owns from a node's depth on, a suffix sum along its own path, taken in
   blocks of ``BLOCK`` turns.

Skew: a conversation that holds a third of all turns is spread by the sort, the
blocks and the split joins; a node that holds a third of all conversations is
summed before the exchange and split in the joins; the list of ids behind
``ends_sha256`` is sorted over all tasks and hashed as a stream of packed blocks.

Defined results: null role or text is empty; a null turn comes first, ties go by
role, then text, as in chat formatting; turns without conv_id belong to no
conversation and are left out; turns given twice count twice; an empty table has
no node, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicegrid.llm.common import text_of, written

P = (1 << 127) - 1
LOW = (1 << 64) - 1
BLOCK = 1024
#: Ids packed into one row on their way to the digest of a node.
PACK = 4096


def base_of(conv: Column) -> Column:
    return conv - conv % 5


def head_of(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 9


def _constant(salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(b"turns %d" % salt).digest(), "big") % (P - 2) + 2


def _halves(v: int) -> tuple[int, int]:
    """127 bits as two longs."""
    low = v & LOW
    return v >> 64, low - (1 << 64) if low >> 63 else low


def _whole(high: int, low: int) -> int:
    return (high << 64) | (low & LOW)


def _folded(batches, r: int):
    """Prefix products of sorted turns, by conversation, from the task's first row on."""
    part, conv, i, f = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        out = [[], [], [], []]
        for c, high, low in zip(*(batch.column(k).to_pylist() for k in range(3))):
            conv, i, f = (c, i, f) if c == conv else (c, 0, 0)
            i, f = i + 1, (f * r + _whole(high, low)) % P
            for column, x in zip(out, (part, i, *_halves(f))):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(c, pa.int64()) for c in out)],
            names=["conv_id", "d_hi", "d_lo", "n_bytes", "part", "pos", "f_hi", "f_lo"])


def _carried(pieces, r: int):
    """Where the part of a conversation in each task begins, and the product before it."""
    import pandas as pd
    out, n, f = [], 0, 0
    for p in pieces.sort_values("part").itertuples():
        out.append((p.conv_id, p.part, n, *_halves(f)))
        f = (f * pow(r, p.n, P) + _whole(p.f_hi, p.f_lo)) % P
        n += p.n
    return pd.DataFrame(out, columns=["c_conv", "c_part", "c_n", "c_hi", "c_lo"])


def placed_turns(turns: DataFrame, salt: int) -> DataFrame:
    """Step 1: (conv_id, pos from 1, digest, bytes, prefix product) of every turn."""
    r = _constant(salt)
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    parts = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]  # 60 bits each
    told = turns.select("conv_id", "turn", "role", "text", parts[0].alias("d_hi"), parts[1].alias("d_lo"))
    clash = told.select("d_hi", "d_lo", "role", "text").distinct().groupBy("d_hi", "d_lo").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not clash.isEmpty():
        return placed_turns(turns, salt + 1)
    order = told.sort("conv_id", F.asc_nulls_first("turn"), "role", "text")
    rows = written(order.select("conv_id", "d_hi", "d_lo", F.octet_length("text").cast("long").alias("n_bytes")).mapInArrow(
        lambda b: _folded(b, r), "conv_id long, d_hi long, d_lo long, n_bytes long, part long, pos long, f_hi long, f_lo long"), "turns")

    # Conversations that lie in several tasks: fewer than there are tasks.
    wide = rows.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("conv_id")
    last = F.max(F.struct("pos", "f_hi", "f_lo"))
    pieces = rows.join(F.broadcast(wide), "conv_id").groupBy("conv_id", "part").agg(last.alias("l")).select(
        "conv_id", "part", F.col("l.pos").alias("n"), "l.f_hi", "l.f_lo")
    carry = pieces.groupBy("conv_id").applyInPandas(lambda p: _carried(p, r), "c_conv long, c_part long, c_n long, c_hi long, c_lo long")
    met = rows.join(F.broadcast(carry), (F.col("conv_id") == F.col("c_conv")) & (F.col("part") == F.col("c_part")), "left")
    moved = _composed(met.select("conv_id", "d_hi", "d_lo", "n_bytes", "f_hi", "f_lo", F.col("pos").alias("k"),
                                 F.col("c_hi").alias("b_hi"), F.col("c_lo").alias("b_lo"), (F.coalesce("c_n", F.lit(0)) + F.col("pos")).alias("pos")), r)
    return written(moved, "placed").withColumn("salt", F.lit(salt))


def _composed(rows: DataFrame, r: int) -> DataFrame:
    """f + b * R^k: what stands in b before the k last turns of f (b null: nothing)."""
    names = [c for c in rows.columns if c not in ("k", "b_hi", "b_lo")]
    at = {c: rows.columns.index(c) for c in rows.columns}

    def run(batches):
        powers: dict[int, int] = {}
        for batch in batches:
            high, low = batch.column(at["f_hi"]).to_pylist(), batch.column(at["f_lo"]).to_pylist()
            for n, (k, b_hi, b_lo) in enumerate(zip(*(batch.column(at[c]).to_pylist() for c in ("k", "b_hi", "b_lo")))):
                if b_hi is None or not (b_hi or b_lo):
                    continue
                if k not in powers:
                    if len(powers) > 100_000:
                        powers.clear()
                    powers[k] = pow(r, k, P)
                high[n], low[n] = _halves((_whole(high[n], low[n]) + _whole(b_hi, b_lo) * powers[k]) % P)
            columns = [pa.array(high, pa.int64()) if c == "f_hi" else pa.array(low, pa.int64()) if c == "f_lo" else batch.column(at[c]) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _differences(rows: DataFrame) -> DataFrame:
    """b = base head - own head, modulo P."""
    def run(batches):
        for batch in batches:
            out = [[], []]
            for a_hi, a_lo, o_hi, o_lo in zip(*(batch.column(k).to_pylist() for k in range(4))):
                for column, x in zip(out, _halves((_whole(a_hi, a_lo) - _whole(o_hi, o_lo)) % P)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], *(pa.array(c, pa.int64()) for c in out)], names=[*batch.schema.names[4:], "b_hi", "b_lo"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[4:])
    return rows.mapInArrow(run, f"{kinds}, b_hi long, b_lo long")


def rebuilt(placed: DataFrame, salt: int, base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of,
            most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Step 2: every conversation (conv_id, length) and every prefix of one turn or more."""
    conv, h = F.col("conv_id"), head(F.col("conv_id")).cast("long")
    at_h = [F.coalesce(F.max(F.when(F.col("pos") == h, F.col(c))), F.lit(0)).alias(f"o_{c}") for c in ("f_hi", "f_lo")]
    own = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *at_h)
    heads = (placed.where((F.col("pos") <= most) & (conv == base(conv))).groupBy(conv.alias("__base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "d_hi", "d_lo", "n_bytes", "f_hi", "f_lo"))).alias("head")))
    met = own.join(heads, base(conv) == F.col("__base"), "left").withColumn("h", h)
    cut = F.coalesce(F.filter("head", lambda t: t["pos"] <= F.col("h")), F.array().cast(heads.schema["head"].dataType))
    met = met.select("conv_id", "n", "h", "o_f_hi", "o_f_lo", cut.alias("head"))
    taken = F.size("head").cast("long")
    end = [F.coalesce(F.get("head", F.size("head") - 1)[c], F.lit(0)) for c in ("f_hi", "f_lo")]
    known = _differences(met.select(*[e.alias(f"a{i}") for i, e in enumerate(end)], "o_f_hi", "o_f_lo", "conv_id", "h", "head", taken.alias("taken"),
                                    (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    convs = written(known, "conversations")

    first = convs.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", "length", F.col("t.pos").alias("depth"), "t.d_hi", "t.d_lo", "t.n_bytes", "t.f_hi", "t.f_lo")
    rest = placed.where(F.col("pos") > h).join(convs.select("conv_id", "h", "length", "taken", "b_hi", "b_lo"), "conv_id").select(
        "conv_id", "length", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "d_hi", "d_lo", "n_bytes", "f_hi", "f_lo",
        (F.col("pos") - F.col("h")).alias("k"), "b_hi", "b_lo")
    prefixes = first.unionByName(_composed(rest, _constant(salt)))
    return convs.select("conv_id", "length"), written(prefixes, "prefixes")


NODE = ["depth", "f_hi", "f_lo"]


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of each node."""
    def pack(batches):
        for batch in batches:
            out, last = [[], [], [], [], []], None
            for *node, conv in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if node == last and len(ids) < PACK:
                    ids.append(conv)
                    continue
                ids, last = [conv], node
                for column, x in zip(out, (*node, conv, ids)):
                    column.append(x)
            out[4] = [",".join(map(str, ids)) for ids in out[4]]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())], names=[*NODE, "first", "ids"])

    def digest(batches):
        last, h = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if node != last:
                    if last is not None:
                        out.append((*last, h.hexdigest()))
                    last, h = node, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends_sha256"], o)) for o in out], shape)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends_sha256"], (*last, h.hexdigest())))], shape)

    shape = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])
    packed = ends.select(*NODE, "conv_id").sort(*NODE, "conv_id").mapInArrow(pack, "depth long, f_hi long, f_lo long, first long, ids string")
    return (packed.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(digest, "depth long, f_hi long, f_lo long, ends_sha256 string"))


def prefix_trie(turns: DataFrame, base: Callable[[Column], Column] = base_of, head: Callable[[Column], Column] = head_of, most: int = 8) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id (its smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``head`` gives at most ``most`` turns."""
    turns = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    salt = 0
    while True:
        placed = placed_turns(turns, salt)
        salt = placed.select("salt").limit(1).collect()
        salt = salt[0].salt if salt else 0
        convs, prefixes = rebuilt(placed.drop("salt"), salt, base, head, most)
        nodes = written(prefixes.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner"), F.max("length").alias("longest"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in ("d_hi", "d_lo") for f in (F.min, F.max)]), "nodes")
        if nodes.where("min_d_hi <> max_d_hi or min_d_lo <> max_d_lo").isEmpty():
            break
        salt += 1

    mine = F.col("owner") == F.col("conv_id")
    met = written(prefixes.join(nodes.select(*NODE, "n_convs", "owner", "longest"), NODE).select(
        *NODE, "conv_id", "length", "owner", F.when(mine, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(0).alias("gain"),
        (mine & (F.col("depth") == F.col("longest"))).cast("long").alias("leaf"), F.floor((F.col("depth") - 1) / BLOCK).alias("block")), "members")
    blocks = met.groupBy("conv_id", "block").agg(
        F.sum("gain").alias("gain"), F.max("leaf").alias("leaf"), F.count_if(~mine).alias("theirs"), F.max(F.when(~mine, F.col("owner"))).alias("above"))
    whole = Window.partitionBy("conv_id")
    later = whole.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    blocks = written(blocks.select(
        "conv_id", "block", F.coalesce(F.sum("gain").over(later), F.lit(0)).alias("later"), F.max("leaf").over(whole).alias("has_leaf"),
        F.sum("theirs").over(whole).alias("theirs"), F.max("above").over(whole).alias("above")), "blocks")

    top = convs.agg(F.min("conv_id").alias("m")).first().m
    inner = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    rows = met.join(blocks, ["conv_id", "block"]).withColumn("saved", F.sum("gain").over(inner) + F.col("later"))
    parent = F.when(F.col("depth") - 1 > F.col("theirs"), F.col("conv_id")).otherwise(F.coalesce("above", F.lit(top)))
    below = F.sum(((F.col("depth") >= F.col("theirs")) & (F.col("depth") < F.col("length"))).cast("long"))
    summed = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max(F.when(mine, parent)).alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
        below.alias("n_children"), F.sum("has_leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    # The root: every conversation; what its members own in all.
    totals = met.agg(F.sum("leaf").alias("leaves"), F.sum("gain").alias("saved"), F.count_if(mine & (F.col("depth") == 1)).alias("children"))
    root = (convs.agg(F.count(F.lit(1)).alias("n_convs")).crossJoin(totals).where("n_convs > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in NODE], F.lit(top).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.col("children").alias("n_children"), F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens")))
    ends = met.where("depth = length").select(*NODE, "conv_id").unionByName(
        convs.where("length = 0").select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id"))
    return (summed.unionByName(root).join(ends_digests(ends), NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
