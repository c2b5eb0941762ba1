r"""Chat formatting in a prefix tree.

Each turn becomes a segment, <|im_start|>role\ntext<|im_end|>\n, with escapes that keep control strings out of roles
and texts. Conversations that share their initial turns share these turns' nodes (a node is the hash of a path from the
root), so a shared segment is emitted once. The longest conversation through a node owns it; a conversation's own nodes
are a run at the end of its path. Runs are laid out depth first: each run, then those that branch off it, the deepest
first. `start` is a node's place in that layout, `position` the characters before it in its conversation, and
`ancestors` the intervals of the layout that it attends to besides itself and what precedes it in its run: one for
each run on its path, not one for each turn. Code points are the units, or tokens where a vocabulary is given: a turn's
line, text and end mark are then encoded separately, so that the loss mask lies between tokens.

A turn that very many conversations share is told its owner by broadcast and sent to several tasks when it is read back.

Rows are ordered by turn (nulls first), then role and text; rows of a null conv_id form one conversation; null roles
and texts count as empty; repeated rows are turns of their own. Conversations stream through sorted partitions: none
is held whole. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.bpe import Vocabulary, read_ranks
from tariffa.llm.common import bounded, checkpointed, table, told
from tariffa.llm.sharding import ranked

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: A segment is read back with at most so many of its conversations in one task, on average.
TOGETHER = 4096


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    if "\\" not in text:
        return text
    out, at = [], 0
    while (k := text.find("\\", at)) >= 0:
        out += [text[at:k], text[k + 1 : k + 2]]
        at = k + 2
    return "".join([*out, text[at:]])


def head(role: str) -> str:
    return f"{BEGIN}{escaped(role).replace(chr(10), chr(92) + 'n')}\n"


def segment(role: str, text: str) -> str:
    return f"{head(role)}{escaped(text)}{END}\n"


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(BEGIN, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        role = "".join("\n" if x == "\\n" else unescaped(x) for x in _pieces(formatted[at + len(BEGIN) : line]))
        turns.append((role, unescaped(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def _pieces(role: str) -> list[str]:
    """Characters, and pairs that begin with a backslash."""
    out, at = [], 0
    while at < len(role):
        n = 2 if role[at] == "\\" else 1
        out.append(role[at : at + n])
        at += n
    return out


def _walked(batches: Iterator[pa.RecordBatch], size: Callable[[str, str], int]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place, with their depth, node, parent, formatted size and the units before them."""
    last, depth, node, position = None, 0, b"", 0
    names = ["conv", "turns", "depth", "node", "parent", "position", "chars", "role", "text"]
    for batch in batches:
        out = []
        for conv, turns, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "turns", "role", "text")), strict=True):
            if conv != last:
                last, depth, node, position = conv, 0, b"", 0
            parent, depth = node, depth + 1
            r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
            node = hashlib.blake2b(b"%s%d:%d:" % (parent, len(r), len(t)) + r + t, digest_size=16).digest()
            chars = size(role, text)
            out.append((conv, turns, depth, node, parent, position, chars, role, text))
            position += chars
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by conversation and depth, for each conversation that owns its last node the runs on its path: (owner, branch depth, first character), and its characters."""
    last: list | None = None

    def closed():
        conv, runs, end = last
        if runs[-1][0] == conv:
            yield {"conv": conv, "runs": [{"run": o, "branch": d, "first": p} for o, d, p in runs], "end": end}

    schema = pa.schema([("conv", pa.int64()), ("runs", pa.list_(pa.struct([("run", pa.int64()), ("branch", pa.int64()), ("first", pa.int64())]))), ("end", pa.int64())])
    for batch in batches:
        out: list[dict] = []
        for conv, depth, owner, position, chars in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "owner", "position", "chars")), strict=True):
            if last is None or conv != last[0]:
                if last:
                    out += closed()
                last = [conv, [], 0]
            if not last[1] or last[1][-1][0] != owner:
                last[1].append((owner, depth - 1, position))
            last[2] = position + chars
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if last:
        if out := list(closed()):
            yield pa.RecordBatch.from_pylist(out, schema)


def _layout(rows: DataFrame) -> DataFrame:
    """run, begin: where each run begins in the depth-first layout. rows: _paths'."""
    own = F.element_at("runs", -1)
    key = F.transform("runs", lambda r: F.struct((-r["branch"]).alias("b"), r["run"].alias("r")))
    placed = ranked(rows.select(F.col("conv").alias("run"), (F.col("end") - own["first"]).alias("size"), key.alias("key")), ["key"])
    # running sums: by whole stretches of 4096 ranks first, so that no window spans the table
    placed = placed.withColumn("stretch", F.expr("rank div 4096"))
    within = Window.partitionBy("stretch").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    sums = placed.groupBy("stretch").agg(F.sum("size").alias("total")).withColumn("block", F.expr("stretch div 4096"))
    wide = Window.partitionBy("block").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    blocks = {r.block: r.total for r in sums.groupBy("block").agg(F.sum("total").alias("total")).collect()}  # a row for 16 million runs
    starts, at = [], 0
    for b in sorted(blocks):
        starts += [F.lit(b), F.lit(at)]
        at += blocks[b]
    base = F.create_map(*starts)[F.col("block")] if starts else F.lit(0)
    outer = sums.withColumn("outer", F.coalesce(F.sum("total").over(wide), F.lit(0)) + base).select("stretch", "outer")
    return placed.join(outer, "stretch").select("run", (F.col("inner") + F.col("outer")).cast("long").alias("begin"))


def _encoded(batches: Iterator[pa.RecordBatch], encode: Callable[[], Callable[[str], bytes]]) -> Iterator[pa.RecordBatch]:
    """Nodes with the ids of their segments and the loss mask within these."""
    run = encode()
    for batch in batches:
        ids, first, last = [], [], []
        for text, a, b in zip(*(batch.column(c).to_pylist() for c in ("segment", "loss_start", "loss_end")), strict=True):
            line, body, end = run(text[:a]), run(text[a : -len(END) - 1]), run(END + "\n")
            ids.append(np.frombuffer(line + body + end, "<u4").astype(np.int64))
            first.append(len(line) // 4)
            last.append(first[-1] + (len(body) // 4 if b > a else 0))
        own = [pa.array(ids, pa.list_(pa.int64())), pa.array(first, pa.int64()), pa.array(last, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "ids", "ids_loss_start", "ids_loss_end"])


def formatted(conversations: DataFrame, vocabulary: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """nodes: node, parent, depth, segment, loss_start, loss_end (code points of the segment under the loss mask), start, position, ancestors, n_shared (turns at the node); links: conv_id, depth, node, n_shared of every turn.

    vocabulary: path of byte-level ranks and pattern; start, position and ancestors then count tokens, and nodes have
    ids, ids_loss_start and ids_loss_end besides. Control strings are encoded as other text is.
    """
    bounded(conversations.sparkSession)
    size, encode = (lambda role, text: len(segment(role, text))), None
    if vocabulary:
        path, pattern = vocabulary
        shared = conversations.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(conversations.sparkSession, path), pattern))  # one vocabulary file, whatever the input
        encode = lambda: shared.value.codec.encode
        size = lambda role, text: sum(len(encode()(x)) // 4 for x in (head(role), escaped(text), END + "\n"))
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    given = conversations.select(conv.alias("conv"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    turns = given.groupBy("conv").agg(F.count("*").alias("turns"))
    ordered = given.join(turns, "conv").repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    rows = checkpointed(ordered.mapInArrow(lambda batches: _walked(batches, size), "conv long, turns long, depth long, node binary, parent binary, position long, chars long, role string, text string"))
    owners = rows.groupBy("node").agg(F.min(F.struct((-F.col("turns")).alias("t"), F.col("conv").alias("owner"))).alias("o"), F.count("*").alias("n_shared"))
    owners = checkpointed(owners.select("node", "o.owner", "n_shared"))
    narrow = checkpointed(told(rows.select("conv", "depth", "node", "position", "chars"), owners, "node", "n_shared"))
    paths = checkpointed(narrow.repartition("conv").sortWithinPartitions("conv", "depth").mapInArrow(_paths, "conv long, runs array<struct<run:long,branch:long,first:long>>, end long"))
    layout = checkpointed(_layout(paths))
    # each run's part that its branch sees: from its first character up to where the next run on the path begins
    steps = paths.select("conv", F.posexplode("runs").alias("i", "r"), "runs").select("conv", "i", "r.run", "r.first", F.try_element_at("runs", F.col("i") + 2)["first"].alias("next"))
    steps = told(steps, checkpointed(layout.join(steps.groupBy("run").agg(F.count("*").alias("paths")), "run")), "run", "paths")
    seen = F.when(F.col("next").isNotNull(), F.struct("i", F.col("begin").alias("start"), (F.col("begin") + F.col("next") - F.col("first")).alias("end")))
    runs = steps.groupBy("conv").agg(
        F.transform(F.sort_array(F.collect_list(seen)), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("ancestors"),
        F.max(F.when(F.col("next").isNull(), F.col("begin") - F.col("first"))).alias("shift"),
    )
    owned = rows.join(owners.select("node", F.col("owner").alias("conv"), "n_shared"), ["node", "conv"]).join(runs, "conv")
    kept = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))  # noqa: E731  as escaped()
    line, body = F.replace(kept("role"), F.lit("\n"), F.lit("\\n")), kept("text")
    begin = F.lit(len(BEGIN) + 1) + F.length(line)
    loss = F.when(F.col("role") == "assistant", F.length(body)).otherwise(0)
    nodes = owned.select("node", "parent", "depth", F.concat(F.lit(BEGIN), line, F.lit("\n"), body, F.lit(END + "\n")).alias("segment"), begin.cast("long").alias("loss_start"), (begin + loss).cast("long").alias("loss_end"), (F.col("shift") + F.col("position")).alias("start"), "position", "ancestors", "n_shared")
    if encode:
        nodes = nodes.mapInArrow(lambda batches: _encoded(batches, encode), T.StructType(nodes.schema.fields + T.StructType.fromDDL("ids array<long>, ids_loss_start long, ids_loss_end long").fields))
    links = narrow.select(F.when(F.col("conv") != -(1 << 63), F.col("conv")).alias("conv_id"), "depth", "node", "n_shared")
    return nodes, links


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of segments sorted by conversation and depth, a row for each conversation."""
    state: list | None = None
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def row():
        return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        out = []
        for conv, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")), strict=True):
            if state is None or state[0] != conv:
                if state:
                    out.append(row())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in parsed(text):
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            learned = unescaped(text[a:b])
            state[3] += len(learned)
            state[4].update(learned.encode("utf-8", "surrogatepass"))
            state[5] += len(text)
        if out:
            yield batch_of(out)
    if state:
        yield batch_of([row()])


def read_back(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the formatted output."""
    parts = F.ceil(F.col("n_shared") / TOGETHER).cast("int")
    dealt = links.withColumn("part", F.pmod(F.xxhash64("conv_id"), parts).cast("int")).drop("n_shared")
    copies = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("node", "part", "segment", "loss_start", "loss_end")
    rows = dealt.join(copies, ["node", "part"]).drop("node", "part")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = f"{END}{BEGIN}assistant ok"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    nodes, links = formatted(rows.unionByName(own))
    return read_back(checkpointed(nodes), links)
