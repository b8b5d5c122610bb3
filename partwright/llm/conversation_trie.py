"""Prefix trie of conversations by van Emde Boas recursion.

Sequences are cut at half depth.  Every cut names a prefix: the name of the forest the
sequence stands in, joined with the name of the upper half's turns.  The upper halves are
the sequences of an upper trie, the lower halves those of the forests that hang
below the cut prefixes; both are cut again in the same step, so depth D takes log2(D)
steps, each a few joins of short rows.  Totals are grafted back from the smallest
pieces to the largest: the roots of a lower forest add up at its cut prefix, and the cut
prefix adds to its ancestors in the upper trie.

Rows are (conversation, depth), never a whole conversation, and never a whole text: a
long conversation is as many rows as it has turns.  Turns and prefixes have 128-bit names
(SHA-256, shortened), which are compared instead of the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partwright.llm.common import WORD_PATTERN, shuffle_partitions, written

# Fixed by the contract: conversations borrow the first turns of the head of their block of ids.
BLOCK = 20
MOST_BORROWED = 3
# Rows of one conversation that a join may bring together: 2 to this power.
CHUNK_BITS = 12
# A prefix with so many children at least, and so large a share of all prefixes, is hot; hence
# at most 1 / HOT_SHARE hot prefixes (about 3 MB) are broadcast, whatever the size of the table.
HOT_CHILDREN = 256
HOT_SHARE = 0.00001
# Conversations whose ids make one piece of a digest's input.
PIECE_IDS = 256

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _name(*parts: Column) -> Column:
    """128-bit name of the concatenated binary parts."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _bytes(text: Column) -> Column:
    return text.cast("binary")


def _root() -> Column:
    return F.unhex(F.lit("00" * 16))


def numbered_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, pos (from 0), token, words: the turns of every conversation in order.

    Order is by turn, null first; turns of equal number go by their name.  One range
    exchange over all rows; a row's number is its place in the whole order less the
    place of its conversation's first, so a conversation may span any number of tasks.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    slim = df.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"),
        F.col(f"`{turn_col}`").alias("turn"),
        # The role's length keeps (role, text) pairs apart whose concatenations agree.
        _name(_bytes(F.octet_length(role).cast("string")), _bytes(F.lit(":")), _bytes(role), _bytes(text)).alias("token"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )
    # Equal rows are spread too: their place in the input is the last part of the key.
    slim = written(slim, "trie_turns").withColumn("row", F.monotonically_increasing_id())
    key = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("token").asc(), F.col("row").asc()]
    ordered = (
        slim.repartitionByRange(shuffle_partitions(df.sparkSession), *key)
        .sortWithinPartitions(*key)
        .select("conv", "token", "words", F.monotonically_increasing_id().alias("at"))
    )
    ordered = written(ordered, "trie_ordered").withColumns(
        {"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    # As many rows as the exchange has partitions.
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return ordered.join(F.broadcast(offsets), "part").select("conv", (F.col("at") + F.col("offset")).alias("place"), "token", "words")


def rebuilt_turns(placed: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: (conv, length) and their turns (conv, i, token, words).

    Conversation c takes the first h turns of its block's head c - c % block, h =
    crc32(decimal c) % (MOST_BORROWED + 1), then its own turns after its first h.
    """
    convs = written(
        placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("own")).withColumns(
            {
                "h": F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_BORROWED + 1),
                "head": F.col("conv") - F.col("conv") % block,
            }
        ),
        "trie_conversations",
    )

    def by_chunk(sides: DataFrame, *columns: str) -> DataFrame:
        """Turns with their conversation's columns, joined on (conversation, chunk of places)."""
        chunks = F.sequence(F.shiftright("first", CHUNK_BITS), F.shiftright(F.col("first") + F.col("own") - 1, CHUNK_BITS))
        many = sides.select("conv", "first", *columns, F.explode(chunks).alias("chunk"))
        turns = placed.withColumn("chunk", F.shiftright("place", CHUNK_BITS))
        return turns.join(many, ["conv", "chunk"]).withColumn("pos", F.col("place") - F.col("first"))

    heads = (
        by_chunk(convs.filter(F.col("conv") % block == 0))
        .filter(F.col("pos") < MOST_BORROWED)
        .groupBy("conv")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "token", "words"))).alias("turns"))  # three at most
        .withColumnRenamed("conv", "head")
    )
    taken = F.coalesce(F.slice("turns", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:bigint,token:binary,words:bigint>>"))
    sides = written(
        convs.join(heads, "head", "left")
        .select("conv", "first", "own", "h", taken.alias("taken"))
        .withColumn("borrowed", F.size("taken").cast("long"))
        .withColumn("length", F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0))),
        "trie_sides",
    )
    borrowed = sides.select("conv", F.explode("taken").alias("t")).select(
        "conv", F.col("t.pos").alias("i"), F.col("t.token").alias("token"), F.col("t.words").alias("words")
    )
    own = by_chunk(sides, "own", "h", "borrowed").filter(F.col("pos") >= F.col("h"))
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("borrowed")).alias("i"), "token", "words")
    return sides.select("conv", "length"), written(borrowed.unionByName(own), "trie_sequences")


def _block_names(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For every level k the names (conv, j, name, words) of the whole blocks of 2^k turns.

    words are those of the block's last turn.
    """
    names = [turns.select("conv", F.col("i").alias("j"), F.col("token").alias("name"), "words")]
    for k in range(1, levels):
        left = F.col("j") % 2 == 0
        pairs = names[-1].groupBy("conv", F.shiftright("j", 1).alias("pair")).agg(
            F.max(F.when(left, F.col("name"))).alias("left"),
            F.max(F.when(~left, F.col("name"))).alias("right"),
            F.max(F.when(~left, F.col("words"))).alias("words"),
        )
        whole = pairs.filter(F.col("left").isNotNull() & F.col("right").isNotNull())
        block = whole.select("conv", F.col("pair").alias("j"), _name(F.col("left"), F.col("right")).alias("name"), "words")
        names.append(written(block, f"trie_blocks_{k}"))
    return names


def _prefixes(lengths: DataFrame, turns: DataFrame, levels: int) -> DataFrame:
    """conv, depth, name and words (of the last turn) of every prefix of every sequence.

    A prefix of depth d is named where d is a cut: at the level of the lowest bit of d.
    """
    names = _block_names(turns, levels)
    segments = lengths.filter(F.col("length") > 0).select("conv", F.lit(0).cast("long").alias("j"), _root().alias("forest"), "length")
    cuts = None
    for k in range(levels, 0, -1):
        upper = names[k - 1].filter(F.col("j") % 2 == 0).select("conv", F.shiftright("j", 1).alias("j"), "name", "words")
        halved = segments.join(upper, ["conv", "j"], "left").withColumns(
            {"cut": _name(F.col("forest"), F.col("name")), "depth": (F.col("j") * 2 + 1) * (1 << (k - 1))}
        )
        if k > 1:
            halved = written(halved, f"trie_cuts_{k}")
        here = halved.filter(F.col("cut").isNotNull()).select("conv", "depth", F.col("cut").alias("name"), "words")
        cuts = here if cuts is None else cuts.unionByName(here)
        below = F.when(
            F.col("cut").isNotNull() & (F.col("length") > F.col("depth")),
            F.array(F.struct((F.col("j") * 2).alias("j"), F.col("forest")), F.struct((F.col("j") * 2 + 1).alias("j"), F.col("cut").alias("forest"))),
        ).otherwise(F.array(F.struct((F.col("j") * 2).alias("j"), F.col("forest"))))
        segments = halved.select("conv", "length", F.explode(below).alias("s")).select("conv", "s.j", "s.forest", "length")
    return written(cuts, "trie_prefixes")


def _graft(nodes: DataFrame, prefixes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (name, parent, conv_id, depth, leaves, saved) with totals over their subtrees.

    Level k: the cut prefixes of level k gain what their lower forests hold, then every
    ancestor between them and the cut above gains their totals.
    """
    sums = ("leaves", "saved")
    for k in range(2, levels + 1):
        half = 1 << (k - 1)
        bits = min(k - 1, CHUNK_BITS)
        lower = nodes.filter(F.col("depth") > 1).filter(((F.col("depth") - 1) % (2 * half)) == half)
        lower = lower.groupBy(F.col("parent").alias("name")).agg(*[F.sum(s).alias(f"more_{s}") for s in sums])
        is_cut = (F.col("depth") % (2 * half)) == half
        cut = nodes.filter(is_cut).join(lower, "name", "left")
        for s in sums:
            cut = cut.withColumn(s, F.col(s) + F.coalesce(F.col(f"more_{s}"), F.lit(0)))
        cut = written(cut.select(*nodes.columns), f"trie_graft_cuts_{k}")
        # The conversation that names a cut prefix passes all its ancestors.
        start, wide = (F.col("depth") - half), k - 1 - bits
        chunks = F.sequence(F.shiftright(start, bits), F.shiftright(start, bits) + ((1 << wide) - 1))
        from_cut = cut.select(F.col("conv_id").alias("conv"), F.explode(chunks).alias("chunk"), *sums)
        between = prefixes.filter((F.col("depth") % (2 * half) < half) & (F.col("depth") % half != 0))
        passed = between.select("conv", F.shiftright("depth", bits).alias("chunk"), "name").join(from_cut, ["conv", "chunk"])
        gained = passed.groupBy("name").agg(*[F.sum(s).alias(f"more_{s}") for s in sums])
        rest = nodes.filter(~is_cut).join(gained, "name", "left")
        for s in sums:
            rest = rest.withColumn(s, F.col(s) + F.coalesce(F.col(f"more_{s}"), F.lit(0)))
        nodes = written(rest.select(*nodes.columns).unionByName(cut), f"trie_graft_{k}")
    return nodes


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv) to pieces (name, first id, ids as text), at most PIECE_IDS ids each."""
    name, ids = None, []

    def piece():
        return pa.RecordBatch.from_pydict(
            {"name": pa.array([name], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]}
        )

    for batch in batches:
        done: list[pa.RecordBatch] = []
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (n != name or len(ids) == PIECE_IDS):
                done.append(piece())
                ids = []
            name = n
            ids.append(c)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if ids:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to (name, digest); holds one digest's state, whatever the number of pieces."""
    name, state = None, None
    for batch in batches:
        names, out = [], []
        for n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if state is not None and n == name:
                state.update(b",")
            else:
                if state is not None:
                    names.append(name)
                    out.append(state.hexdigest())
                name, state = n, hashlib.sha256()
            state.update(text.encode())
        if names:
            yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.binary()), "ends_sha256": out})
    if state is not None:
        yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "ends_sha256": [state.hexdigest()]})


def _end_digests(ends: DataFrame) -> DataFrame:
    """name, ends_sha256 of (name, conv): SHA-256 of the ids in ascending order, comma between two.

    The ids of one name are sorted and joined to pieces in any number of tasks; only its pieces meet
    in one task, one after another, as the digest of a text has to read it in order.
    """
    n = shuffle_partitions(ends.sparkSession)
    pieces = (
        ends.repartitionByRange(n, "name", "conv")
        .sortWithinPartitions("name", "conv")
        .select("name", "conv")
        .mapInArrow(_joined_ids, "name binary, first long, ids string")
    )
    return (
        pieces.repartition(n, "name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(_digests, "name binary, ends_sha256 string")
    )


def prefix_trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie of sequences: ``lengths`` (conv, length), ``turns`` (conv, i from 0, token, words).

    One row per node, the root included: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  No sequences, no nodes.
    """
    most = lengths.agg(F.max("length")).first()[0]
    levels = max(1, int(most or 0).bit_length())
    prefixes = _prefixes(lengths, turns, levels)
    grouped = prefixes.groupBy("name").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("depth").alias("depth"), F.max("words").alias("words")
    )
    grouped = written(grouped, "trie_nodes")
    # The conversation that names a node also passes its parent.
    above = prefixes.select(F.col("conv").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    linked = written(
        grouped.join(above, ["conv_id", "depth"], "left").withColumn("parent", F.coalesce("parent", _root())), "trie_linked"
    )
    children = linked.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter(F.col("n_convs") > 0)
    root = root.select(_root().alias("name"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"))
    every = linked.unionByName(root, allowMissingColumns=True).join(children, "name", "left")
    every = written(every.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie_every")

    values = every.filter("depth > 0").select(
        "name",
        "parent",
        "conv_id",
        "depth",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    totals = _graft(values, prefixes, levels).select("name", "leaves", "saved")
    tops = every.filter("depth = 1").select("name").join(totals, "name")
    of_root = tops.agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))
    totals = totals.unionByName(of_root.select(_root().alias("name"), F.col("leaves").cast("long").alias("leaves"), "saved"))

    last = prefixes.join(lengths.withColumnRenamed("length", "depth"), ["conv", "depth"]).select("name", "conv")
    turnless = lengths.filter("length = 0").select(_root().alias("name"), "conv")
    digests = _end_digests(last.unionByName(turnless))

    hot_from = max(HOT_CHILDREN, int(HOT_SHARE * every.count()))
    own = every.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = own.filter(F.col("n_children") >= hot_from).select("parent", F.col("parent_conv_id").alias("hot_conv"))
    rest = own.filter((F.col("n_children") > 0) & (F.col("n_children") < hot_from)).drop("n_children")
    marked = every.join(F.broadcast(hot), "parent", "left")
    of_hot = marked.filter(F.col("hot_conv").isNotNull()).withColumnRenamed("hot_conv", "parent_conv_id")
    others = marked.filter(F.col("hot_conv").isNull()).drop("hot_conv").join(rest, "parent", "left")
    full = of_hot.unionByName(others).join(totals, "name").join(digests, "name", "left")
    return full.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def conversation_trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", rebuild: bool = True
) -> DataFrame:
    """The prefix trie of the conversations of ``df``, one row per node (see :func:`prefix_trie`).

    Turns go by number, null first; equal numbers by the turn's name, so the order of input rows
    never counts and repeated rows are turns of their own.  A null role or text is empty.  Rows
    without a conversation id belong to none and make no node.  With ``rebuild`` the contract's borrowed
    turns are put in front (:func:`rebuilt_turns`).  Other columns are not read, so their names
    cannot clash.  An empty table gives no rows; texts of any length only leave a name and a word count.
    """
    placed = written(numbered_turns(df, conv_col, turn_col, role_col, text_col), "trie_placed")
    if rebuild:
        lengths, turns = rebuilt_turns(placed)
    else:
        convs = placed.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("length"))
        chunks = F.sequence(F.shiftright("first", CHUNK_BITS), F.shiftright(F.col("first") + F.col("length") - 1, CHUNK_BITS))
        many = convs.select("conv", "first", F.explode(chunks).alias("chunk"))
        turns = placed.withColumn("chunk", F.shiftright("place", CHUNK_BITS)).join(many, ["conv", "chunk"])
        turns = written(turns.select("conv", (F.col("place") - F.col("first")).alias("i"), "token", "words"), "trie_sequences")
        lengths = convs.select("conv", "length")
    return prefix_trie(lengths, turns)
