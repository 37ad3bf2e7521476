"""Chat transcripts: roles recovered by a hidden Markov model, then canonical turns.

A conversation is its rows in order of ``turn`` (nulls last, ties by text), each row one or more lines. The
states are the roles. A line is observed by what may be a speaker marker (a listed word with a colon or in
brackets: "User:", "[assistant]", "<|system|>"), its length, a closing question mark, its place in the row and the
number of lines of the row. Emissions, those of markers too, the role that starts and the role that follows are
counted over all training rows (crc32 of ``conv_id`` modulo 5 is not 0); the word list only proposes markers and
weighs like ``LISTED`` rows. Inside a row the role stays unless a marker allows a change. Viterbi then recovers the
roles from the text alone, and each run of lines with one role is rendered as a turn. A marker is taken off
only where the recovered role is the one it mostly stands for; else it is text of the turn, as are bare words.
All other characters are kept; of roles with equal scores the first by name is taken.

Conversations are decoded in blocks of ``TURNS`` turn numbers, so one that holds a third of all rows is many
tasks: each block gives a max-plus matrix (best score from every state before it to every state at its
end), the matrices of a conversation are chained, and every block is decoded between its two states. That
is exactly Viterbi over the whole conversation.

A null or empty text is one empty line and gives one turn. Rows without ``conv_id`` are one conversation.
Repeated rows are repeated turns. Without any training role every turn is ``user``. Any number of roles will do: a
line costs their square, a line of a conversation of several blocks their cube.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.matrices import FOLDS
from aerolith.llm.tables import NO_ID, id_value, stored

TURNS = 256
STAY = 0.999
LISTED, SURE = 5.0, 0.98
# Words that speaker markers use, by the role they mostly stand for.
MARKERS = {
    "system": ("system", "sys", "instruction", "instructions"),
    "user": ("user", "human", "question", "q", "me", "customer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
    "tool": ("tool", "function"),
}
_WORD = {word: role for role, words in MARKERS.items() for word in words}
_PLACE = {word: n for n, word in enumerate(_WORD)}
MARKER_FEATURE = 4
_NAMES = "|".join(sorted(_WORD, key=len, reverse=True))
# In brackets, or followed by a colon; signs of headings and bold type may stand around the word.
_MARKER = re.compile(
    rf"^\s*(?:\[(?P<a>{_NAMES})\]:?|<\|(?P<b>{_NAMES})\|>:?|<(?P<c>{_NAMES})>:?|(?:#{{1,4}}\s*)?(?:\*\*)?(?P<d>{_NAMES})(?:\*\*)?\s*:(?:\*\*)?)\s*",
    re.I,
)
TURN = "conv_id long, turn long, part int, role string, content string, rendered string, given string"


def line_features(text: str | None) -> list[tuple[str, int, tuple[int, ...], str | None]]:
    """Of each line: the line, where its content begins if its marker is one, its observed features, the marker's word."""
    lines = (text or "").split("\n")
    out = []
    for n, line in enumerate(lines):
        marker = _MARKER.match(line) if ":" in line or "]" in line or ">" in line else None
        word = next(w for w in marker.groups() if w).lower() if marker else None
        features = (len(line).bit_length(), int(line.rstrip().endswith("?")), min(n, 3), min(len(lines), 5))
        out.append((line, marker.end() if marker else 0, features, word))
    return out


@dataclass
class RoleModel:
    """Log scores. The state after the last role is the one before a conversation begins."""

    roles: list[str]
    moves: list[np.ndarray]  # to a row's first line, to a line inside a row, to a line with a marker
    emission: list[dict[int, np.ndarray]]
    unseen: list[np.ndarray]
    markers: dict[str, np.ndarray]  # the share of each role in a marker's uses

    def stands_for(self, word: str | None) -> int:
        """The role that a marker mostly stands for; -1 for no marker, or one of no known role."""
        return int(self.markers[word].argmax()) if word in self.markers else -1

    def steps(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The move into each line, and the line's emission."""
        n = len(self.roles)
        for text in texts:
            lines = line_features(text)
            marked = any(word in self.markers for *_, word in lines)  # then the row's shape says nothing of its lines
            for nth, (_, _, features, word) in enumerate(lines):
                score = np.zeros(n)
                for k, value in enumerate(features[:2] if marked else features):
                    score = score + self.emission[k].get(value, self.unseen[k])
                if word in self.markers:
                    score = score + np.log(self.markers[word])
                yield self.moves[0 if nth == 0 else 2 if word in self.markers else 1], np.append(score, -np.inf)

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        """Best score from each state before these rows to each state at their end."""
        n = len(self.roles) + 1
        best = np.where(np.eye(n) > 0, 0.0, -np.inf)
        rows = max(1, (1 << 20) // (n * n))
        for move, score in self.steps(texts):
            if rows >= n:
                best = (best[:, :, None] + move[None]).max(axis=1) + score
            else:
                parts = [(best[at : at + rows, :, None] + move[None]).max(axis=1) for at in range(0, n, rows)]
                best = np.concatenate(parts) + score
        return best

    def path(self, texts: list[str | None], entry: int, last: int) -> list[int]:
        """States of all lines, between the state before them and the state at their end."""
        best = np.where(np.arange(len(self.roles) + 1) == entry, 0.0, -np.inf)
        back = []
        for move, score in self.steps(texts):
            reach = best[:, None] + move
            back.append(reach.argmax(axis=0))
            best = reach.max(axis=0) + score
        states = [last]
        for step in back[:0:-1]:
            states.append(int(step[states[-1]]))
        return states[::-1]


def chained(matrices: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Best states before and at the end of each block of one conversation."""
    states = len(matrices[0])
    best = np.where(np.arange(states) == states - 1, 0.0, -np.inf)
    back = []
    for matrix in matrices:
        reach = best[:, None] + matrix
        back.append(reach.argmax(axis=0))
        best = reach.max(axis=0)
    lasts = [int(best.argmax())]
    entries = [int(back[-1][lasts[0]])]
    for step in back[-2::-1]:
        lasts.append(entries[-1])
        entries.append(int(step[lasts[-1]]))
    return entries[::-1], lasts[::-1]


def marker_shares(roles: list[str], counted: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each role's share in the uses of a marker: those counted, and those the list stands for."""
    shares = {}
    for word, named in _WORD.items():
        seen = counted.get(word, np.zeros(len(roles)))
        if named in roles:
            rest = (1 - SURE) / max(len(roles) - 1, 1)
            seen = seen + LISTED * np.array([SURE if role == named else rest for role in roles])
        elif seen.sum() < LISTED:
            continue  # a word that stands for no role here, and that few rows open with
        shares[word] = (seen + 0.01) / (seen + 0.01).sum()
    return shares


def fitted(
    roles: list[str], start: np.ndarray, follow: np.ndarray, emission: list, unseen: list, markers: dict[str, np.ndarray]
) -> RoleModel:
    n = len(roles)

    def move(inside: np.ndarray, begin: np.ndarray) -> np.ndarray:
        out = np.full((n + 1, n + 1), -np.inf)
        with np.errstate(divide="ignore"):
            out[:n, :n], out[n, :n] = np.log(inside), np.log(begin)
        return out

    share = np.full((n, n), 1 / n)
    stay = np.eye(n) * STAY + share * (1 - STAY)
    first = move(follow / follow.sum(axis=1, keepdims=True), start / start.sum())
    return RoleModel(roles, [first, move(stay, share[0]), move(share, share[0])], emission, unseen, markers)


def _rows(conversations: DataFrame) -> DataFrame:
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(NO_ID))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv_id"),
        turn.alias("turn"),
        F.floor(turn / TURNS).cast("long").alias("block"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("role").cast("string").alias("given"),
    )


def train(rows: DataFrame) -> RoleModel:
    learned = rows.where((F.crc32(F.col("conv_id").cast("string")) % FOLDS != 0) & F.col("given").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text, role in zip(batch.column("text").to_pylist(), batch.column("given").to_pylist(), strict=True):
                lines = line_features(text)
                for _, _, features, _ in lines:
                    for k, value in enumerate(features):
                        seen[role, k, value] += 1
                # The marker that opens a row stands for the row's role; later ones may name others.
                if lines[0][3]:
                    seen[role, MARKER_FEATURE, _PLACE[lines[0][3]]] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32())]
            + [pa.array([k[2] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())],
            ["role", "feature", "value", "n"],
        )

    named = learned.select("given").distinct().collect()
    roles = sorted(r.given for r in named) or ["user"]
    place = {r: n for n, r in enumerate(roles)}
    counts = learned.select("text", "given").mapInArrow(count, "role string, feature int, value int, n long").groupBy("role", "feature", "value").agg(F.sum("n").alias("n")).collect()
    totals = np.ones((4, len(roles)))
    table: list[dict[int, np.ndarray]] = [{} for _ in range(4)]
    marked: dict[str, np.ndarray] = {}
    for r in counts:
        if r.feature == MARKER_FEATURE:
            marked.setdefault(list(_WORD)[r.value], np.zeros(len(roles)))[place[r.role]] += r.n
            continue
        table[r.feature].setdefault(r.value, np.zeros(len(roles)))[place[r.role]] += r.n
        totals[r.feature, place[r.role]] += r.n
    emission = [{v: np.log((n + 0.1) / total) for v, n in one.items()} for one, total in zip(table, totals, strict=True)]
    # The turn before is joined by its number: no window over a whole conversation.
    dated = learned.where(F.col("turn") < NO_ID)
    before = dated.select("conv_id", F.try_add("turn", F.lit(1)).alias("turn"), F.col("given").alias("before")).distinct()
    pairs = dated.join(before, ["conv_id", "turn"], "left").groupBy("before", "given").count().collect()
    start, follow = np.full(len(roles), 0.1), np.full((len(roles), len(roles)), 0.1)
    for r in pairs:
        if r.before is None:
            start[place[r.given]] += r["count"]
        else:
            follow[place[r.before], place[r.given]] += r["count"]
    return fitted(roles, start, follow, emission, [np.log(0.1 / t) for t in totals], marker_shares(roles, marked))


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches; a run may cross batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        columns = [np.asarray(batch.column(k)) for k in keys]
        cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            mine = tuple(c[a] for c in columns)
            if held and mine != key:
                yield pa.Table.from_batches(held)
                held = []
            key = mine
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def canonical_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, turn, part, role, content, rendered, given``."""
    rows = _rows(conversations)
    model = conversations.sparkSession.sparkContext.broadcast(train(rows))
    states = len(model.value.roles) + 1
    in_blocks = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "text")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv_id", "block"]):
            best = model.value.matrix(group.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array([group.column(c)[0].as_py()], pa.int64()) for c in ("conv_id", "block")] + [pa.array([best.reshape(-1).tolist()])],
                ["conv_id", "block", "best"],
            )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv_id"]):
            entries, lasts = chained([np.array(m).reshape(states, states) for m in group.column("best").to_pylist()])
            columns = [group.column("conv_id").combine_chunks(), group.column("block").combine_chunks()]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(entries, pa.int32()), pa.array(lasts, pa.int32())], ["conv_id", "block", "entry", "last"])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv_id", "block"]):
            texts = group.column("text").to_pylist()
            path = iter(model.value.path(texts, group.column("entry")[0].as_py(), group.column("last")[0].as_py()))
            out = []
            conv = group.column("conv_id")[0].as_py()
            for turn, text, given in zip(group.column("turn").to_pylist(), texts, group.column("given").to_pylist(), strict=True):
                parts: list[tuple[int, list[str]]] = []
                for line, begin, _, word in line_features(text):
                    state = next(path)
                    true_marker = model.value.stands_for(word) == state
                    content = line[begin:] if true_marker else line
                    if parts and parts[-1][0] == state and not true_marker:
                        parts[-1][1].append(content)
                    else:
                        parts.append((state, [content]))
                for n, (state, lines) in enumerate(parts):
                    role, content = model.value.roles[state], "\n".join(lines)
                    out.append((conv, turn, n, role, content, f"<|{role}|>\n{content}\n<|end|>\n", given))
            names = [f.split()[0] for f in TURN.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    blocks = stored(in_blocks.mapInArrow(matrices, "conv_id long, block long, best array<double>"), "blocks")
    ends = (
        blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(chain, "conv_id long, block long, entry int, last int")
    )
    decoded = (
        rows.join(ends, ["conv_id", "block"])
        .repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "turn", "text")
        .mapInArrow(render, TURN)
    )
    return decoded.withColumns({"conv_id": id_value("conv_id"), "turn": id_value("turn")})


def chat_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, part, held_out, role, rendered`` and whether the stored role is the recovered one."""
    return canonical_turns(conversations).select(
        "conv_id",
        "turn",
        "part",
        (F.crc32(F.coalesce(F.col("conv_id"), F.lit(NO_ID)).cast("string")) % FOLDS == 0).alias("held_out"),
        "role",
        "rendered",
        (F.col("role") == F.col("given")).alias("agrees"),
    )
