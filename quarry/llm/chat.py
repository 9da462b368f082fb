"""Transcript parsing: a hidden Markov model recovers roles.

Input lines ``(conv_id, turn, tie, idx, line[, role])`` in order of
(turn, tie, idx).  Every line has an observation built from its speaker
marker (system, user, assistant, a further learned role, some other name,
none), whether an empty line comes before it, its length and a final question
mark.  All roles of the training lines are learned; the model grows with them.  Hidden states
are a role's first line and its later lines; transitions and emissions are
counted over all labelled lines.  Viterbi decoding finds the best states, and
turns are rendered in one canonical form.

A conversation may be of any length: lines are range-partitioned by their
order and cut into chunks of at most ``CHUNK``.  A chunk's best paths are one
(max, +) matrix; a forward and a backward pass stream over the matrices of a
conversation and fix the state at every chunk border; then each chunk is
decoded by itself.  The result is that of Viterbi over the whole.

Columns of other names than those listed are ignored, whatever they are
called.  Null conv_ids form one conversation; a null turn comes first; a null text is
an empty line.  Rows with equal (conv_id, turn) follow each other in order of
their text; repeated rows are repeated lines.  Empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import constant_array, staged, table

CHUNK = 4096
PARTITIONS = 64
SMOOTHING = 0.1
FOLDS, HELD = 5, 0  # conversations whose crc32 leaves HELD are not learned from

# fixed values: speaker words by class
SPEAKERS = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "prompter", "customer", "question", "q", "you", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "agent", "gpt"),
}
MARKERS = ("none", *SPEAKERS, "name")
#: A speaker word in brackets, or before a colon, at the start of a line.
MARKER = r"^\s{0,3}(?:#{1,4}\s{0,2}|\*\*)?(?:<\|?|\[)?\s?([A-Za-z][A-Za-z0-9_]{0,31})\s?(?:\|?>:?|\]:?|:\**|\*\*:)(?:\s+|$)"

# fixed values: marker styles in which a table of turns is written as transcripts (system, user, assistant)
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("### Instruction: ", "### Human: ", "### Assistant: "),
    ("[system] ", "[user] ", "[assistant] "),
    ("<|system|> ", "<|user|> ", "<|assistant|> "),
    ("Context: ", "Q: ", "A: "),
    ("**System**: ", "**Customer**: ", "**Agent**: "),
)
KEY = ("conv_id", "turn", "tie", "idx")


def transcripts(turns: DataFrame, unmarked: int = 8) -> DataFrame:
    """Write (conv_id, turn, role, text) rows as transcript lines: a marker in
    the conversation's style before each turn, an empty line after it.  One
    turn in ``unmarked`` has no marker.  ``role`` is on every line, as label."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    names = F.create_map(*[x for i, r in enumerate(("system", "user", "assistant")) for x in
                           (F.lit(r), F.get(F.array(*[F.lit(s[i]) for s in STYLES]), style))])
    plain = F.pmod(F.xxhash64("conv_id", "turn", F.lit(1)), F.lit(unmarked)) == 0
    mark = F.when(plain, "").otherwise(F.coalesce(F.element_at(names, F.col("role")), F.concat("role", F.lit(": ")), F.lit("")))
    lines = F.split(F.concat(mark, F.col("text"), F.lit("\n")), "\n")
    return rows.select("conv_id", "turn", F.xxhash64("text", "role").alias("tie"), "role", F.posexplode(lines).alias("idx", "line"))


def learning(lines: DataFrame) -> DataFrame:
    """The lines of conversations outside the held-out fold; a null conv_id is held out."""
    return lines.where(F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % FOLDS, F.lit(HELD)) != HELD)


def learned_roles(lines: DataFrame) -> list[str]:
    """All roles of the labelled training lines, the most frequent first."""
    counts = learning(lines).where("role IS NOT NULL").groupBy("role").count().orderBy(F.desc("count"), "role")
    return [r["role"] for r in counts.collect()]


def role_words(roles: list[str]) -> list[str]:
    """Learned roles that are no known speaker word: each is a marker class of its own."""
    known = {w for words in SPEAKERS.values() for w in words}
    return sorted({r.lower() for r in roles} - known - {""})


def cut_markers(roles: list[str]) -> list[int]:
    """The marker classes that name a learned role: only those are cut off a turn."""
    own = {r.lower() for r in roles}
    spoken = [i + 1 for i, words in enumerate(SPEAKERS.values()) if own & set(words)]
    return spoken + [len(MARKERS) + i for i in range(len(role_words(roles)))]


def _speaker(line: Column, words: list[str]) -> Column:
    word = F.lower(F.regexp_extract(line, MARKER, 1))
    found = F.when(word == "", F.lit(0))
    for i, known in enumerate(SPEAKERS.values()):
        found = found.when(word.isin(*known), F.lit(i + 1))
    if words:
        at = F.array_position(constant_array(words, "string"), word).cast("int")
        found = found.when(at > 0, at + (len(MARKERS) - 1))
    return found.otherwise(F.lit(len(MARKERS) - 1))


def observed(lines: DataFrame, words: list[str]) -> DataFrame:
    """Adds ``marker`` and ``shape``: what of the observation needs one line only."""
    size = F.length(F.trim(F.col("line")))
    shape = F.when(size == 0, 0).when(size < 80, 1).when(size < 400, 2).otherwise(3) * 2 + F.col("line").rlike(r"\?\s*$").cast("int")
    return lines.withColumns({"marker": _speaker(F.col("line"), words), "shape": shape.cast("int")})


def symbols(words: list[str]) -> int:
    """How many observations there are: marker, shape, empty line before."""
    return (len(MARKERS) + len(words)) * 8 * 2


def _cut(batches):
    """Number the chunks of sorted lines and add the observation symbol.

    A chunk ends with its conversation, its partition, or at CHUNK lines; its
    number grows in the order of the lines."""
    import pyarrow as pa
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    chunk, filled, last, blank = (part << 33) - 1, 0, None, 1
    for b in batches:
        convs, markers, shapes = (b.column(c).to_pylist() for c in ("conv_id", "marker", "shape"))
        chunks, at, symbols = [], [], []
        for conv, marker, shape in zip(convs, markers, shapes, strict=True):
            if last is None or conv != last[0]:
                chunk, filled, last, blank = chunk + 1, 0, (conv,), 1
            elif filled == CHUNK:
                chunk, filled = chunk + 1, 0
            chunks.append(chunk)
            at.append(filled)
            symbols.append((marker * 8 + shape) * 2 + blank)
            filled += 1
            blank = int(shape < 2)
        keep = [n for n in b.schema.names if n not in ("marker", "shape")]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(n) for n in keep), pa.array(markers, pa.int32()), pa.array(chunks, pa.int64()), pa.array(at, pa.int32()),
             pa.array(symbols, pa.int32())], names=[*keep, "marker", "chunk", "at", "symbol"])


def chunked(lines: DataFrame, partitions: int = PARTITIONS, words: list[str] = ()) -> DataFrame:
    """Lines with (chunk, at, symbol), written once; ``words``: the learned roles' own markers."""
    cols = "conv_id long, turn long, tie long, role string, idx int, line string"
    ordered = (observed(lines, list(words)).select("conv_id", "turn", "tie", "role", "idx", "line", "marker", "shape")
               .repartitionByRange(partitions, *KEY).sortWithinPartitions(*KEY))
    return staged(ordered.mapInArrow(_cut, f"{cols}, marker int, chunk long, at int, symbol int"), "chat-lines")


def train(lines: DataFrame, roles: list[str] | None = None, words: list[str] = ()):
    """(roles, log transitions, log emissions) from the labelled lines.

    State 0 is the start of a conversation; role r has the states 1 + 2 r
    (first line) and 2 + 2 r (later lines).  Counts over all lines, by
    aggregation; one row per pair of states and per state and symbol reaches
    the driver."""
    import numpy as np
    roles = learned_roles(lines) if roles is None else roles
    k = 1 + 2 * len(roles)
    moves, shows = np.full((k, k), SMOOTHING), np.full((k, symbols(list(words))), SMOOTHING)
    role = F.array_position(constant_array(roles, "string"), F.col("role")).cast("int") - 1
    states = learning(lines).select("conv_id", "chunk", "at", "symbol", F.when(role >= 0, 1 + 2 * role + (F.col("idx") > 0).cast("int")).alias("state"))
    for r in states.where("state IS NOT NULL").groupBy("state", "symbol").count().collect():
        shows[r["state"], r["symbol"]] += r["count"]
    # a line follows the one before it, in its chunk or at the end of the conversation's chunk before
    inside, between = Window.partitionBy("chunk").orderBy("at"), Window.partitionBy("conv_id").orderBy("chunk")
    within = states.where(F.col("at") >= 0).select("at", "state", F.lag("state").over(inside).alias("from")).where("at > 0").select("from", "state")
    ends = states.groupBy("conv_id", "chunk").agg(F.min_by("state", "at").alias("state"), F.max_by("state", "at").alias("last"))
    borders = ends.select(F.when(F.row_number().over(between) == 1, 0).otherwise(F.lag("last").over(between)).alias("from"), "state")
    for r in within.unionByName(borders).where("from IS NOT NULL AND state IS NOT NULL").groupBy("from", "state").count().collect():
        moves[r["from"], r["state"]] += r["count"]
    moves[:, 0] = 1e-300
    for s in range(k):  # a later line belongs to the turn of the line before it
        for t in range(2, k, 2):
            if s not in (t, t - 1):
                moves[s, t] = 1e-300
    shows[0] = 1.0
    return roles, np.log(moves / moves.sum(axis=1, keepdims=True)), np.log(shows / shows.sum(axis=1, keepdims=True))


def _groups(batches, *names):
    """Consecutive rows of one chunk: (chunk, {name: list})."""
    last, rows = None, None
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("chunk", *names)]
        for chunk, *values in zip(*cols, strict=True):
            if chunk != last:
                if rows is not None:
                    yield last, rows
                last, rows = chunk, []
            rows.append(values)
    if rows is not None:
        yield last, rows


def viterbi(symbols, moves, shows, alpha, end=None):
    """(scores after the last symbol, best states): from the scores before the first."""
    import numpy as np
    back = []
    for s in symbols:
        step = alpha[:, None] + moves
        back.append(step.argmax(axis=0))
        alpha = step.max(axis=0) + shows[:, s]
    state = int(alpha.argmax()) if end is None else end
    path = []
    for b in reversed(back):
        path.append(state)
        state = int(b[state])
    return alpha, path[::-1], state, np.array(back)


def decode(lines: DataFrame, model) -> DataFrame:
    """``lines`` (of ``chunked``) with the best ``state`` of each."""
    import numpy as np
    _, moves, shows = model
    k = len(moves)

    def matrices(batches):
        import pyarrow as pa
        for chunk, rows in _groups(batches, "conv_id", "symbol"):
            m = np.full((k, k), -np.inf)
            np.fill_diagonal(m, 0.0)
            for _, s in rows:
                m = (m[:, :, None] + moves[None, :, :]).max(axis=1) + shows[:, s][None, :]
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int64()), pa.array([chunk], pa.int64()),
                                              pa.array([m.ravel().tolist()], pa.list_(pa.float64()))], names=["conv_id", "chunk", "m"])

    def forward(batches):
        """The scores of the states before each chunk."""
        import pyarrow as pa
        last, alpha = None, None
        for b in batches:
            out = []
            for conv, m in zip(b.column("conv_id").to_pylist(), b.column("m").to_pylist(), strict=True):
                if last is None or conv != last[0]:
                    last, alpha = (conv,), np.where(np.arange(k) == 0, 0.0, -np.inf)
                out.append(alpha.tolist())
                alpha = (alpha[:, None] + np.array(m).reshape(k, k)).max(axis=0)
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("chunk"), b.column("m"), pa.array(out, pa.list_(pa.float64()))],
                                             names=["conv_id", "chunk", "m", "alpha"])

    def backward(batches):
        """The states at both borders of each chunk, from the last chunk on."""
        import pyarrow as pa
        last, end = None, None
        for b in batches:
            starts, ends = [], []
            for conv, m, alpha in zip(*(b.column(c).to_pylist() for c in ("conv_id", "m", "alpha")), strict=True):
                scores = np.array(alpha)[:, None] + np.array(m).reshape(k, k)
                if last is None or conv != last[0]:
                    last, end = (conv,), int(scores.max(axis=0).argmax())
                start = int(scores[:, end].argmax())
                starts.append(start)
                ends.append(end)
                end = start
            yield pa.RecordBatch.from_arrays([b.column("chunk"), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                                             names=["chunk", "start", "end"])

    def within(batches):
        import pyarrow as pa
        for chunk, rows in _groups(batches, "at", "symbol", "start", "end"):
            alpha = np.where(np.arange(k) == rows[0][2], 0.0, -np.inf)
            _, path, _, _ = viterbi([r[1] for r in rows], moves, shows, alpha, rows[0][3])
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array(path, pa.int32())], names=["chunk", "at", "state"])

    small = lines.select("conv_id", "chunk", "at", "symbol")
    by_chunk = small.repartition("chunk").sortWithinPartitions("chunk", "at")
    m = staged(by_chunk.mapInArrow(matrices, "conv_id long, chunk long, m array<double>"), "chat-matrices")
    alphas = m.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        forward, "conv_id long, chunk long, m array<double>, alpha array<double>")
    borders = staged(alphas.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk")).mapInArrow(
        backward, "chunk long, start int, end int"), "chat-borders")
    states = (small.join(borders, "chunk").select("chunk", "at", "symbol", "start", "end")
              .repartition("chunk").sortWithinPartitions("chunk", "at").mapInArrow(within, "chunk long, at int, state int"))
    return lines.join(states, ["chunk", "at"])


def render(decoded: DataFrame, roles: list[str]) -> DataFrame:
    """(conv_id, turn, role, content, rendered): the recovered turns in order.

    Markers that name a learned role are cut off (``Note:`` stays), the empty
    lines around a turn dropped."""
    role = F.get(constant_array(roles, "string"), ((F.col("state") - 1) / 2).cast("int"))
    first = (F.col("state") % 2 == 1).cast("int")
    begins = decoded.groupBy("conv_id", "chunk").agg(F.sum(first).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = begins.select("chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("chunk").orderBy("at")  # CHUNK rows at most
    content = F.when((first == 1) & F.col("marker").isin(cut_markers(roles)), F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    numbered = decoded.join(offset, "chunk").select(
        "conv_id", (F.col("before") + F.sum(first).over(inside) - 1).alias("turn"), "chunk", "at", role.alias("role"), content.alias("line"))
    turns = numbered.groupBy("conv_id", "turn").agg(
        F.first("role").alias("role"), F.sort_array(F.collect_list(F.struct("chunk", "at", "line"))).alias("lines"))
    text = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")
    return turns.select("conv_id", "turn", "role", text.alias("content")).withColumn(
        "rendered", F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "content", F.lit("<|im_end|>\n")))


def parse(lines: DataFrame) -> DataFrame:
    """Train on the labelled lines, decode all, render."""
    roles = learned_roles(lines)
    words = role_words(roles)
    cut = chunked(lines, words=words)
    return render(decode(cut, train(cut, roles, words)), roles)


def op9_chat(spark, sf_dir):
    return parse(transcripts(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
