"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is a conversation's lines in order; speakers are marked in many
styles ("User: ", "[bot] ", "### Human: "), or not at all.  A line's state is a
role and whether it opens a turn or goes on with one.  Its observation is the
kind of its speaker marker, its length and whether it asks a question.  The
model's probabilities are smoothed counts over labelled conversations; the
most likely states are found by Viterbi, and the turns they make are rendered
in one canonical form.

A conversation of any length is decoded without being gathered: its lines are
cut into blocks of ``BLOCK`` places, and Viterbi's maximum over paths is taken
in three steps.  Each block gives the best score from every state before it to
every state at its end (a matrix); the blocks' matrices, one small row each,
give every block's first and last state on the best path; with these the blocks
are decoded on their own.  Within a task all blocks advance together, one line
a step.

A null text is one empty line; a null conversation id is a conversation of its
own; rows of equal place are ordered by a hash of their text, repeated rows
after each other; an empty table gives an empty result.  Without labelled
conversations all probabilities are equal but for the markers' own roles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlens.llm.frames import stored

ROLES = ("system", "user", "assistant")
#: Places (turns, or lines) of a block.
BLOCK = 512
#: States: a role's turn begins, a role's turn goes on.
N_STATES = 2 * len(ROLES)
#: Names of speakers.
NAMES = {"system": ("system", "sys", "context"),
         "user": ("user", "human", "customer", "client", "question", "q"),
         "assistant": ("assistant", "bot", "ai", "agent", "model", "answer", "a")}
MARKER = r"^\s*(?:#+\s*|\*\*)?[\[<]?\|?([A-Za-z]{1,12})\|?(?:\*\*)?[\]>:]+\s*"
LENGTHS = (40, 120, 400)
KINDS = len(ROLES) + 2
N_SEEN = KINDS * (len(LENGTHS) + 1) * 2
#: Added to every count; a marker that names the state's role counts more.
SMOOTHING = 0.1
MARKED = 1.0


def observation(line: Column) -> Column:
    """What the model sees of a line, as one number below ``N_SEEN``."""
    name = F.lower(F.regexp_extract(line, MARKER, 1))
    kind = F.when(name == "", 0)
    for i, role in enumerate(ROLES):
        kind = kind.when(name.isin(*NAMES[role]), i + 1)
    kind = kind.otherwise(KINDS - 1)
    size = F.lit(0)
    for least in LENGTHS:
        size = size + (F.length(line) >= least).cast("int")
    asks = F.rtrim(line).endswith("?").cast("int")
    return ((kind * (len(LENGTHS) + 1) + size) * 2 + asks).cast("int")


def without_marker(line: Column) -> Column:
    """The line's text after a known speaker's marker."""
    known = F.lower(F.regexp_extract(line, MARKER, 1)).isin(*[n for names in NAMES.values() for n in names])
    return F.when(known, F.regexp_replace(line, MARKER, "")).otherwise(line)


def lines_of(df: DataFrame, conv_col: str, place_col: str, text_col: str, *more: Column) -> DataFrame:
    """The lines of ``df``'s texts: conv, place, tie, row, line, text, seen."""
    text = F.coalesce(df[text_col], F.lit(""))
    rows = df.select(df[conv_col].alias("conv"), df[place_col].cast("long").alias("place"),
                     F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"),
                     *more, text.alias("whole"))
    split = rows.select("*", F.posexplode_outer(F.split("whole", "\n")).alias("line", "text")).drop("whole")
    return split.withColumns({"seen": observation(F.col("text")),
                              "block": F.floor(F.coalesce("place", F.lit(0)) / BLOCK)})


def fit(turns: DataFrame, lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log probabilities: of first states, of transitions, of observations.

    ``turns``: conv, place, role and n_lines of labelled conversations;
    ``lines``: role, line (from 0 in its turn) and seen.  Only counts reach the
    driver, a few dozen."""
    code = F.when(F.lit(False), 0)
    for i, role in enumerate(ROLES):
        code = code.when(F.col("role") == role, i)
    first, move = np.zeros(N_STATES), np.zeros((N_STATES, N_STATES))
    emit = np.full((N_STATES, N_SEEN), SMOOTHING / 10)
    n = len(ROLES)
    for i in range(n):  # a marker speaks for its role, at the start of a turn
        marked = slice((i + 1) * (len(LENGTHS) + 1) * 2, (i + 2) * (len(LENGTHS) + 1) * 2)
        emit[i, marked] += MARKED / ((len(LENGTHS) + 1) * 2)
    first[:n] += SMOOTHING
    move[:, :n] += SMOOTHING
    for i in range(n):  # a turn goes on with its own role only
        move[i, n + i] += SMOOTHING
        move[n + i, n + i] += SMOOTHING
    seen = lines.withColumn("code", code).where("code is not null") \
        .groupBy("code", (F.col("line") > 0).alias("on"), "seen").count().collect()
    for r in seen:
        emit[r.code + n * r.on, r.seen] += r["count"]
    known = turns.withColumn("code", code).where("code is not null").select("conv", "place", "code", "n_lines")
    before = known.select(F.col("conv").alias("c"), (F.col("place") + 1).alias("p"),
                          F.col("code").alias("last"), F.col("n_lines").alias("last_lines"))
    pairs = known.join(before, F.col("conv").eqNullSafe(F.col("c")) & (F.col("place") == F.col("p")), "left") \
        .groupBy("code", "last", (F.col("last_lines") > 1).alias("long")).count().collect()
    for r in pairs:
        if r.last is None:
            first[r.code] += r["count"]
        else:
            move[r.last + n * bool(r.long), r.code] += r["count"]
    inner = known.groupBy("code").agg(F.count_if(F.col("n_lines") > 1).alias("two"),
                                      F.sum(F.greatest(F.col("n_lines") - 2, F.lit(0))).alias("on")).collect()
    for r in inner:
        move[r.code, n + r.code] += r.two
        move[n + r.code, n + r.code] += r.on

    def log(counts: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(counts / counts.sum(axis=-1, keepdims=True))

    return log(first), log(move), log(emit)


class Blocks:
    """Rows of a task that belong together, sorted; all advance together."""

    def __init__(self, new: np.ndarray):
        """``new``: whether a row begins a block."""
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(new)))
        self.order = np.argsort(-self.size, kind="stable")

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per step: the blocks that have such a row, and the row."""
        size = self.size[self.order]
        for t in range(int(size[0]) if len(size) else 0):
            live = self.order[:np.searchsorted(-size, -t, "left")]
            yield live, self.first[live] + t


def block_matrices(blocks: Blocks, seen: np.ndarray, model: tuple) -> np.ndarray:
    """Best scores from each state before a block to each state at its end."""
    _, move, emit = model
    score = np.full((len(blocks.first), N_STATES, N_STATES), -np.inf)
    score[:, np.arange(N_STATES), np.arange(N_STATES)] = 0
    for live, row in blocks.steps():
        step = (score[live][:, :, :, None] + move[None, None]).max(axis=2)
        score[live] = step + emit[:, seen[row]].T[:, None, :]
    return score


def block_ends(conversations: Blocks, matrices: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Each block's state before it (-1 for a conversation's first) and at
    its end, on the best path of its conversation; ``matrices`` of a first
    block begin in a conversation's first state (``first_matrices``)."""
    n = len(matrices)
    back = np.zeros((n, N_STATES), np.int64)
    best = np.zeros((len(conversations.first), N_STATES))
    for t, (live, row) in enumerate(conversations.steps()):
        if t == 0:
            best[live] = matrices[row][:, 0]
        else:
            step = best[live][:, :, None] + matrices[row]
            back[row], best[live] = step.argmax(axis=1), step.max(axis=1)
    enter, leave = np.full(n, -1), np.zeros(n, np.int64)
    state = best.argmax(axis=1)
    for t, (live, row) in reversed(list(enumerate(conversations.steps()))):
        leave[row] = state[live]
        if t:
            state[live] = back[row, state[live]]
            enter[row] = state[live]
    return enter, leave


def decode_blocks(blocks: Blocks, seen: np.ndarray, enter: np.ndarray, leave: np.ndarray,
                  model: tuple) -> np.ndarray:
    """The best path's state at every row, given the blocks' ends."""
    first, move, emit = model
    best = np.zeros((len(blocks.first), N_STATES))
    back = np.zeros((len(seen), N_STATES), np.int8)
    for t, (live, row) in enumerate(blocks.steps()):
        if t == 0:
            arrive = np.where((enter[live] < 0)[:, None], first[None], move[np.maximum(enter[live], 0)])
        else:
            step = best[live][:, :, None] + move[None]
            back[row], arrive = step.argmax(axis=1), step.max(axis=1)
        best[live] = arrive + emit[:, seen[row]].T
    out = np.zeros(len(seen), np.int64)
    state = leave.copy()
    for t, (live, row) in reversed(list(enumerate(blocks.steps()))):
        out[row] = state[live]
        if t:
            state[live] = back[row, state[live]]
    return out


def first_matrices(matrices: np.ndarray, blocks: Blocks, seen: np.ndarray, opens: np.ndarray,
                   model: tuple) -> np.ndarray:
    """Row 0 of the matrices of blocks that open a conversation: best scores
    from its beginning."""
    first, move, emit = model
    which = np.flatnonzero(opens)
    if len(which):
        score = np.full((len(blocks.first), N_STATES), -np.inf)
        is_open = opens.copy()
        for t, (live, row) in enumerate(blocks.steps()):
            live, row = live[is_open[live]], row[is_open[live]]
            arrive = first[None] if t == 0 else (score[live][:, :, None] + move[None]).max(axis=1)
            score[live] = arrive + emit[:, seen[row]].T
        matrices[which, 0] = score[which]
    return matrices


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _changes(*columns: pa.ChunkedArray) -> np.ndarray:
    """Whether a row differs from the one before in any column."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        codes = column.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return new


def parse(lines: DataFrame, model: tuple) -> DataFrame:
    """``lines`` (see ``lines_of``, stored) with ``state``, the number
    ``turn`` of the line's turn in its conversation, and ``role``."""
    opening = lines.groupBy(F.col("conv").alias("c")).agg(F.min("block").alias("first"))
    known = lines.join(opening, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    keys = ["conv", "block", "place", "tie", "row", "line"]
    conv = lines.schema["conv"].dataType.simpleString()

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        blocks = Blocks(_changes(table.column("conv"), table.column("block")))
        seen = table.column("seen").to_numpy()
        heads = table.take(blocks.first)
        opens = heads.column("block").to_numpy() == heads.column("first").to_numpy()
        made = first_matrices(block_matrices(blocks, seen, model), blocks, seen, opens, model)
        yield pa.RecordBatch.from_arrays(
            [heads.column("conv").combine_chunks(), heads.column("block").combine_chunks(),
             pa.array(list(made.reshape(len(made), -1)), pa.list_(pa.float64()))], ["conv", "block", "matrix"])

    dealt = known.select(*keys, "seen", "first").repartition("conv", "block").sortWithinPartitions(*keys)
    made = dealt.mapInArrow(matrices, f"conv {conv}, block long, matrix array<double>")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        values = table.column("matrix").combine_chunks().values.to_numpy().reshape(-1, N_STATES, N_STATES)
        enter, leave = block_ends(Blocks(_changes(table.column("conv"))), values, model)
        yield pa.RecordBatch.from_arrays(
            [table.column("conv").combine_chunks(), table.column("block").combine_chunks(),
             pa.array(enter, pa.int32()), pa.array(leave, pa.int32())], ["c", "b", "enter", "leave"])

    paths = stored(made.repartition("conv").sortWithinPartitions("conv", "block")
                   .mapInArrow(ends, f"c {conv}, b long, enter int, leave int"), "paths")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        blocks = Blocks(_changes(table.column("conv"), table.column("block")))
        heads = table.take(blocks.first)
        state = decode_blocks(blocks, table.column("seen").to_numpy(), heads.column("enter").to_numpy(),
                              heads.column("leave").to_numpy().astype(np.int64), model)
        starts = np.cumsum(state < len(ROLES))
        before = np.append(0, starts)[blocks.first]
        local = starts - np.repeat(before, blocks.size)
        out = table.drop_columns(["enter", "leave"])
        out = out.append_column("state", pa.array(state, pa.int32())).append_column("local", pa.array(local))
        yield from out.combine_chunks().to_batches()

    both = lines.join(paths, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields)
    decoded = stored(both.repartition("conv", "block").sortWithinPartitions(*keys)
                     .mapInArrow(states, schema + ", state int, local long"), "states")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = decoded.groupBy("conv", "block").agg(F.max("local").alias("starts")) \
        .select(F.col("conv").alias("c"), F.col("block").alias("b"),
                F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("base"))
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("state") % len(ROLES) + 1)
    return decoded.join(base, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))) \
        .withColumns({"turn": F.col("base") + F.col("local") - 1, "role": role}).drop("c", "b", "base", "local")


def render(parsed: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per recovered turn: conversation, ``turn``, ``role``,
    ``n_lines``, its ``text`` without marker and the canonical ``rendered``."""
    own = F.when(F.col("state") < len(ROLES), without_marker(F.col("text"))).otherwise(F.col("text"))
    line = F.struct("place", "tie", "row", "line", own.alias("text"))
    turns = parsed.groupBy("conv", "turn").agg(F.min("role").alias("role"),
                                               F.sort_array(F.collect_list(line)).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    return turns.select(
        F.col("conv").alias(conv_col), "turn", "role", F.size("lines").alias("n_lines"), text.alias("text"),
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n<|end|>\n")).alias("rendered"))


#: Marker styles and speakers' names of raw transcripts.
STYLES = ("{}: ", "[{}] ", "<{}> ", "**{}**: ", "### {}: ", "{}> ")


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as raw transcripts: a style and
    names by conversation, and every eighth marker left out, by hashes."""
    pick = lambda n, *keys: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int") + 1
    name = F.lit(None).cast("string")
    for role, names in NAMES.items():
        spoken = F.element_at(F.array(*[F.lit(n.capitalize()) for n in names]),
                              pick(len(names), F.col("conv_id"), F.lit(role)))
        name = F.when(F.col("role") == role, spoken).otherwise(name)
    style = [s.split("{}") for s in STYLES]
    at = pick(len(STYLES), F.col("conv_id"), F.lit("style"))
    left, right = (F.element_at(F.array(*[F.lit(s[i]) for s in style]), at) for i in (0, 1))
    bare = name.isNull() | (pick(8, F.col("conv_id"), F.col("turn"), F.lit("bare")) == 1)
    marker = F.when(bare, "").otherwise(F.concat(left, name, right))
    return turns.withColumn("raw", F.concat(marker, F.coalesce("text", F.lit(""))))
