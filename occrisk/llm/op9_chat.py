"""Chat formatting: a hidden Markov model finds the turns of a transcript and their roles.

A transcript is lines without roles; some turns open with a speaker marker
("Human:", "A:", ...), some do not.  States are (role, first line of a turn or
a later one); each line is seen as a marker class and line features.  The
model's tables are smoothed counts, gathered by Spark over all labelled lines;
Viterbi finds the likeliest states; turns are then rendered in one form.

Long conversations are decoded in chunks of CHUNK turns that see MARGIN turns
on both sides, so no task holds a conversation of any length.

Defined results: equal (conversation, turn, role, text) rows are one turn;
turns of equal number follow in the order of their texts; rows without a
conversation or turn number are transcripts of their own; a NULL text is one
empty line; unknown or NULL roles are not learned from; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table

CHUNK = 64
MARGIN = 8

ROLES = ("system", "user", "assistant")
STATES = tuple((role, first) for role in ROLES for first in (True, False))

# Speaker markers by role, one column per transcript style.
MARKERS = {
    "system": ("System:", "Context:", "### System:", "[system]"),
    "user": ("User:", "Q:", "### Human:", "[user]"),
    "assistant": ("Assistant:", "A:", "### Assistant:", "[assistant]"),
}
STYLES = 4

FEATURES = ("marker", "words", "ending", "opening")


# ---------------------------------------------------------------- lines and features (built-in functions)


def _marker_class(text: Column) -> Column:
    found = F.lit("none")
    for role, forms in MARKERS.items():
        for form in forms:
            found = F.when(F.startswith(text, F.lit(form)), F.lit(role)).otherwise(found)
    return found


def with_features(lines: DataFrame) -> DataFrame:
    text = F.col("text")
    count = F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), " +")))
    return lines.select(
        "*",
        _marker_class(text).alias("marker"),
        F.when(count == 0, 0).otherwise(F.least(F.lit(9), 1 + F.floor(F.log2(count)))).cast("int").alias("words"),
        F.when(F.endswith(text, F.lit("?")), "ask").when(F.endswith(text, F.lit(":")), "colon").when(F.endswith(text, F.lit(".")), "stop").otherwise("open").alias("ending"),
        F.when(F.substring(text, 1, 1) == F.upper(F.substring(text, 1, 1)), "upper").otherwise("lower").alias("opening"),
    )


def transcripts(turns: DataFrame) -> DataFrame:
    """Lines of transcripts made from (conv_id, turn, role, text): (conv_id, turn, tie, line, text, role).

    The conversation chooses the style of its markers; about one turn in six, but
    never a conversation's first, goes without one.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct()
    style = F.pmod(F.xxhash64("conv_id"), F.lit(STYLES)).cast("int")
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0) & (F.col("turn") > 0)
    forms = F.lit(None).cast("string")
    for role, names in MARKERS.items():
        forms = F.when(F.col("role") == role, F.get(F.array(*map(F.lit, names)), style)).otherwise(forms)
    opened = F.when(bare | forms.isNull(), F.col("text")).otherwise(F.concat(forms, F.lit(" "), F.col("text")))
    marked = rows.select("conv_id", "turn", F.xxhash64("text", "role").alias("tie"), "role", opened.alias("_text"))
    return marked.select("conv_id", "turn", "tie", "role", F.posexplode(F.split("_text", "\n", -1)).alias("line", "text"))


# ---------------------------------------------------------------- model


class RoleModel:
    """Start, transition and emission log probabilities from counts, with one added to each."""

    def __init__(self, starts: dict, moves: dict, seen: dict[str, dict], values: dict[str, list]):
        def logs(counts: dict, keys: list) -> dict:
            total = math.log(sum(counts.get(k, 0) for k in keys) + len(keys))
            return {k: math.log(counts.get(k, 0) + 1) - total for k in keys}

        states = list(STATES)
        self.start = logs(starts, states)
        self.move = {s: logs({t: moves.get((s, t), 0) for t in states}, states) for s in states}
        self.emit = {f: {s: logs({v: seen[f].get((s, v), 0) for v in values[f]}, values[f]) for s in states} for f in FEATURES}

    def score(self, state: tuple[str, bool], line: tuple) -> float:
        return sum(self.emit[f][state].get(v, -20.0) for f, v in zip(FEATURES, line))

    def decode(self, lines: list[tuple]) -> list[tuple[str, bool]]:
        """The likeliest states of one transcript (Viterbi)."""
        known: dict[tuple, dict] = {}
        best: dict = {}
        back: list[dict] = []
        for n, line in enumerate(lines):
            if line not in known:
                known[line] = {s: self.score(s, line) for s in STATES}
            own = known[line]
            if n == 0:
                # a transcript opens with the first line of a turn
                best = {s: own[s] + self.start[s] + (0.0 if s[1] else -50.0) for s in STATES}
                continue
            came, now = {}, {}
            for s in STATES:
                from_ = max(STATES, key=lambda p: best[p] + self.move[p][s])
                came[s], now[s] = from_, best[from_] + self.move[from_][s] + own[s]
            best = now
            back.append(came)
        if not lines:
            return []
        path = [max(STATES, key=best.get)]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]


def fit(lines: DataFrame) -> RoleModel:
    """Count the labelled lines (`role` known); what comes back has one row per combination of features."""
    known = F.col("role").isin(*ROLES)
    labelled = lines.where(known)
    counts = labelled.groupBy("role", (F.col("line") == 0).alias("first"), *FEATURES).agg(F.count("*").alias("n")).collect()
    seen: dict[str, dict] = {f: {} for f in FEATURES}
    for row in counts:
        for f in FEATURES:
            key = ((row["role"], row["first"]), row[f])
            seen[f][key] = seen[f].get(key, 0) + row["n"]
    values = {f: sorted({v for _, v in seen[f]}) or [None] for f in FEATURES}
    values["marker"] = sorted({*values["marker"], "none", *ROLES} - {None})
    # a turn of k lines: k - 2 steps among its later lines, one from first to later; then a step to the next turn
    turns = lines.groupBy("conv_id", "turn", "role").agg(F.count("*").alias("k"))
    follow = turns.alias("a").join(turns.alias("b"), (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("a.turn") + 1 == F.col("b.turn")), "left")
    steps = (
        follow.where(F.col("a.role").isin(*ROLES))
        .groupBy(F.col("a.role").alias("role"), (F.col("a.k") > 1).alias("long"), (F.col("a.turn") == 0).alias("opens"), F.col("b.role").alias("next"))
        .agg(F.count("*").alias("n"), F.sum("a.k").alias("k"))
        .collect()
    )
    starts: dict = {}
    moves: dict = {}

    def add(table: dict, key, n: int) -> None:
        table[key] = table.get(key, 0) + n

    for row in steps:
        first, later = (row["role"], True), (row["role"], False)
        if row["opens"]:
            add(starts, first, row["n"])
        if row["long"]:
            add(moves, (first, later), row["n"])
            add(moves, (later, later), row["k"] - 2 * row["n"])
        if row["next"] in ROLES:
            add(moves, (later if row["long"] else first, (row["next"], True)), row["n"])
    return RoleModel(starts, moves, seen, values)


# ---------------------------------------------------------------- decoding


def canonical(role: str, lines: list[str]) -> str:
    """One turn in the output form; a marker that opens it is dropped."""
    head = lines[0]
    for forms in MARKERS.values():
        for form in forms:
            if head.startswith(form):
                return f"<|{role}|>\n" + "\n".join([head[len(form) :].removeprefix(" "), *lines[1:]]) + "\n<|end|>\n"
    return f"<|{role}|>\n" + "\n".join(lines) + "\n<|end|>\n"


TURN = "conv_id string, turn string, line int, role string, continues boolean, n_lines int, text string"


def _decoder(model: RoleModel):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, lines in zip(batch["conv_id"], batch["lines"]):
                states = model.decode([tuple(x[f] for f in FEATURES) for x in lines])
                turn: list[str] = []
                for x, (role, first) in zip(lines, states):
                    if not x["own"]:
                        continue
                    if first or not turn:
                        turn = []
                        out.append([conv, x["name"], x["line"], role, not first, turn])
                    turn.append(x["text"])
            yield pd.DataFrame(
                {
                    "conv_id": [r[0] for r in out],
                    "turn": [r[1] for r in out],
                    "line": [r[2] for r in out],
                    "role": [r[3] for r in out],
                    "continues": [r[4] for r in out],
                    "n_lines": [len(r[5]) for r in out],
                    "text": [canonical(r[3], r[5]) for r in out],
                }
            )

    return decode


def parse(lines: DataFrame, model: RoleModel) -> DataFrame:
    """Recovered turns of transcripts: where each begins, its role, its canonical text.

    `continues` marks a turn that began in the chunk before.
    """
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    own = F.when(placed, F.floor(F.col("turn") / CHUNK)).otherwise(F.col("tie"))
    near = F.array_distinct(F.array(*[F.floor((F.col("turn") + m) / CHUNK) for m in (-MARGIN, 0, MARGIN)]))
    chunk = F.explode(F.when(placed, near).otherwise(F.array(F.col("tie"))))
    line = F.struct("turn", "tie", "line", F.col("turn").cast("string").alias("name"), (F.col("chunk") == F.col("own")).alias("own"), "text", *FEATURES)
    chunks = (
        with_features(lines)
        .select("*", placed.alias("placed"), own.alias("own"), chunk.alias("chunk"))
        .groupBy("conv_id", "chunk", "placed")
        .agg(F.array_sort(F.collect_list(line)).alias("lines"))
    )
    # numbers go as strings: pandas would turn integers beside a NULL into doubles
    turns = chunks.select(F.col("conv_id").cast("string").alias("conv_id"), "lines").mapInPandas(_decoder(model), TURN)
    return turns.withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    lines = stored(with_features(transcripts(table(spark, sf_dir, "conversations"))), "transcripts")
    return parse(lines.drop(*FEATURES), fit(lines))
