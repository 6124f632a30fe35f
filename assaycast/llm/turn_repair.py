"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Edits of a row: keep it, change its role, delete it; an empty
user or assistant row can be inserted anywhere. The search goes depth first through the edits in ASCII order of their initials (D, I,
K, R) under a bound on the cost; the bound starts at a lower bound and rises to the least value that a failed search left
open. A table holds, for every state that failed, the cost that is now known to be needed from there, so no state
fails twice under the same bound. The first accepting path is the cheapest, and the ASCII-least of the cheapest.

Rows are sorted over the whole table into tasks of equal share, whatever conversations they belong to. A run of up to ``RUN``
rows of a conversation is searched from every state to every state; runs, and then the shares of several tasks, are
joined by the same search, with whole runs as edits. Ranks stand for their paths: each path ends with the edit
of a row, so none is the beginning of another, and the order of the first one that differs decides.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaycast.llm.text import small
from assaycast.sources.tables import cut_lineage

# ---- fixed values -----------------------------------------------------------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANK = "^[\\x20\\x09-\\x0D]*\\z"
WHOLE = "[.!?][\\x20\\x09-\\x0D]*\\z"
# -----------------------------------------------------------------------------------------
#: States: nothing yet, after the system row, after a user row, after an assistant row.
STATES = 4
ACCEPTING = (0, 3)
#: State and initial of the row that may follow; a system row may only come first.
NEXT = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
NEVER = 1 << 40
RUN = 256
NO_FAULT, IS_BLANK, IS_COPY, IS_CUT = range(4)
INITIALS = "sua"


def search(edits: list[list[list[tuple]]], least: list[int], start: int, goal: int | None, proven: dict[int, int]):
    """Cost and labels of the first cheapest path through ``edits``, or None.

    edits[i][q]: (label, rows passed, next state, cost) in the order to be tried; least[i]: a lower bound of the cost from row i
    on; goal: the last state, None if any accepting one will do; proven: lower bounds of failed states, which may be
    used for other starts of the same goal.
    """
    n = len(edits)
    if not proven:
        proven.update(_dead_ends(edits, ACCEPTING if goal is None else (goal,)))

    def needs(i: int, q: int) -> int:
        return max(least[i], proven.get(i * STATES + q, 0))

    bound = needs(0, start)
    while bound < NEVER:
        frames = [[0, start, bound, 0, NEVER]]  # row, state, what is left of the bound, next edit, least need seen
        path: list = []
        while frames:
            frame = frames[-1]
            i, q, left, k, need = frame
            if i == n:
                if q == goal if goal is not None else q in ACCEPTING:
                    return bound, path
                options = ()
            else:
                options = edits[i][q]
            while k < len(options):
                label, step, to, cost = options[k]
                k += 1
                rest = cost + needs(i + step, to)
                if rest > left:
                    need = min(need, rest)
                    continue
                frame[3], frame[4] = k, need
                frames.append([i + step, to, left - cost, 0, NEVER])
                path.append(label)
                break
            else:
                frames.pop()
                proven[i * STATES + q] = need = max(need, left + 1)
                if frames:
                    last = path.pop()
                    up = frames[-1]
                    cost = edits[up[0]][up[1]][up[3] - 1][3]
                    up[4] = min(up[4], cost + need)
                    assert last == edits[up[0]][up[1]][up[3] - 1][0]
        bound = proven.get(start, NEVER)
    return None


def _dead_ends(edits: list[list[list[tuple]]], goals: tuple[int, ...]) -> dict[int, int]:
    """``NEVER`` for every state from which no edits lead to the goals; without these, insertions would be tried for ever."""
    out: dict[int, int] = {}
    alive = set(goals)
    for i in range(len(edits), -1, -1):
        if i < len(edits):
            here = {q for q in range(STATES) if any(step and to in alive for _, step, to, _ in edits[i][q])}
            grown = True
            while grown:
                more = {q for q in range(STATES) if any(not step and to in here for _, step, to, _ in edits[i][q])} - here
                here |= more
                grown = bool(more)
            alive = here
        out.update({i * STATES + q: NEVER for q in range(STATES) if q not in alive})
    return out


def row_edits(code: int) -> tuple[list[list[tuple]], int]:
    """Edits of a row in each state, and the least cost of any; code: 4 * initial (s, u, a, other) + fault."""
    initial, fault = divmod(code, 4)
    out, extra = [], TRUNCATED if fault == IS_CUT else 0
    for q in range(STATES):
        to, expected = NEXT[q]
        options = [("D", 1, q, DELETE), ("I", 0, to, INSERT)]
        if fault not in (IS_BLANK, IS_COPY):
            if initial < 3 and INITIALS[initial] == expected:
                options.append(("K", 1, to, KEEP + extra))
            elif initial == 0 and q == 0:
                options.append(("K", 1, 1, KEEP + extra))
            options.append(("R", 1, to, REROLE + extra))
        out.append(options)
    least = DELETE if fault in (IS_BLANK, IS_COPY) else min(DELETE, extra) if initial < 3 else min(DELETE, REROLE + extra)
    return out, least


ROWS = [row_edits(code) for code in range(16)]
#: After the last row: what is missing is inserted.
END = [[("", 1, 0, 0)], [("II", 1, 3, 2 * INSERT)], [("I", 1, 3, INSERT)], [("", 1, 3, 0)]]


def _suffix(least: list[int]) -> list[int]:
    return np.append(np.cumsum(np.array(least[::-1], np.int64))[::-1], 0).tolist()


@functools.lru_cache(maxsize=50_000)
def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation of one run."""
    edits = [ROWS[c][0] for c in codes] + [END]
    cost, path = search(edits, _suffix([ROWS[c][1] for c in codes] + [0]), 0, None, {})
    return cost, "".join(path)


@functools.lru_cache(maxsize=2_000)
def between(codes: bytes) -> tuple[tuple, ...]:
    """(state before, state after, cost, path) of a run, for all states between which there is a path."""
    edits, least = [ROWS[c][0] for c in codes], _suffix([ROWS[c][1] for c in codes])
    # a path must end with the edit of a row: no insertions behind the last one
    out = []
    for goal in range(STATES):
        proven: dict[int, int] = {}
        for start in range(STATES):
            found = search(edits, least, start, goal, proven)
            if found:
                out.append((start, goal, found[0], "".join(found[1])))
    return tuple(out)


def run_edits(options: list[tuple]) -> tuple[list[list[tuple]], int]:
    """Edits that stand for a run: label (state before, state after), in the order of their paths; options: before, after, cost, rank."""
    out = [[] for _ in range(STATES)]
    for before, after, cost, rank in sorted(options, key=lambda o: o[3]):
        out[before].append(((before, after), 1, after, cost))
    return out, min(o[2] for o in options)


def join_runs(runs: list[tuple]) -> list[tuple]:
    """``between`` of several runs in a row."""
    if len(runs) == 1:
        return list(runs[0])
    made = [run_edits(r) for r in runs]
    edits, least = [m[0] for m in made], _suffix([m[1] for m in made])
    texts = [{(o[0], o[1]): o[3] for o in r} for r in runs]
    out = []
    for goal in range(STATES):
        proven: dict[int, int] = {}
        for start in range(STATES):
            found = search(edits, least, start, goal, proven)
            if found:
                out.append((start, goal, found[0], "".join(t[label] for t, label in zip(texts, found[1]))))
    return out


# ---- tables -----------------------------------------------------------------------------
SHARE = (
    "conv_id {kind}, part long, whole boolean, n_rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
    "cost long, options array<struct<before:int,after:int,cost:long,rank:int,path:string>>"
)


def keyed(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, text, hash``: null roles and texts are one space."""
    text_ = F.coalesce(F.col(text), F.lit(" "))
    return turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"), text_.alias("text"),
        F.md5(text_).alias("hash"),
    )


def coded_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, hash, copy, code`` of every row of ``keyed``: fault and role without the text."""
    text = F.col("text")
    fault = F.when(text.rlike(BLANK), IS_BLANK).when(~text.rlike(WHOLE), IS_CUT).otherwise(NO_FAULT)
    slim = rows.select("conv_id", "turn", "role", "hash", fault.alias("fault"))
    # rows that repeat are one row with a number until their faults are known
    runs = slim.groupBy("conv_id", "turn", "role", "hash", "fault").agg(F.count(F.lit(1)).alias("n"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = runs.groupBy("conv_id", "role", "hash").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns"))
    again = again.where("turns > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    met = runs.join(again, same, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    later = (F.col("copy") > 1) | (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn")))
    found = F.when(later & (F.col("fault") != IS_BLANK), IS_COPY).otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return met.select("conv_id", "turn", "role", "hash", "copy", (place * 4 + found).alias("code"))


def along(*more: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *(F.col(c) for c in more), F.col("turn").asc_nulls_first(), F.col("role"), F.col("hash"), F.col("copy")]


def shares(coded: DataFrame) -> DataFrame:
    """One row for each conversation and task that holds rows of it: counts, and the cheapest paths between states.

    Conversations that begin and end inside a task are solved there.
    """
    kind = dict(coded.dtypes)["conv_id"]
    ordered = coded.repartitionByRange(*along()).sortWithinPartitions(*along()).select("conv_id", "code")
    schema = SHARE.format(kind=kind)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        codes, now, first = bytearray(), None, True

        def row(conv, codes: bytes, whole: bool) -> dict:
            initials = ["sua?"[c // 4] for c in codes]
            faults = np.bincount(np.frombuffer(bytes(codes), np.uint8) % 4, minlength=4).tolist()
            illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
            if whole and len(codes) <= RUN:
                cost, path = cheapest(bytes(codes))
                options = [(0, 0, cost, 0, path)]
            else:
                runs = [between(bytes(codes[i : i + RUN])) for i in range(0, len(codes), RUN)]
                found = sorted(join_runs(runs), key=lambda o: o[3])
                rank = {p: k for k, p in enumerate(sorted({o[3] for o in found}))}
                options = [(b, a, c, rank[p], p) for b, a, c, p in found]
                if whole:
                    cost, path = finish([[o[:4] for o in options]])
                    text = next(o[4] for o in options if (o[0], o[1]) == path[0]) + path[-1]
                    options = [(0, 0, cost, 0, text)]
            names = ["before", "after", "cost", "rank", "path"]
            return {
                "conv_id": conv, "part": part, "whole": whole, "n_rows": len(codes), "blank": faults[IS_BLANK], "duplicate": faults[IS_COPY],
                "truncated": faults[IS_CUT], "illegal": illegal, "first": initials[0], "last": initials[-1],
                "cost": options[0][2] if whole else None, "options": [dict(zip(names, o)) for o in options],
            }

        out = []
        for b in batches:
            convs, code = b.column("conv_id").to_pylist(), b.column("code").to_numpy().astype(np.uint8)
            change = np.flatnonzero([x != y for x, y in zip(convs, convs[1:])]) + 1
            for a, z in zip([0, *change.tolist()], [*change.tolist(), len(convs)]):
                if a == z:
                    continue
                if codes and convs[a] != now:
                    # the first and the last conversation of a task may go on in another one
                    out.append(row(now, codes, not first))
                    codes, first = bytearray(), False
                now = convs[a]
                codes += code[a:z].tobytes()
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if codes:
            out.append(row(now, codes, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(coded.sparkSession.createDataFrame([], schema).schema)
    return ordered.mapInArrow(run, schema)


def finish(runs: list[list[tuple]]) -> tuple[int, list]:
    """Cost, and the states around each run and the last insertions, of a whole conversation; runs: before, after, cost, rank."""
    made = [run_edits(r) for r in runs]
    return search([m[0] for m in made] + [END], _suffix([m[1] for m in made] + [0]), 0, None, {})


def audits(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, n_rows, blank, duplicate, truncated, illegal, cost, parts`` of every conversation that has rows.

    ``parts`` are the pieces of the audit in their order. Order of rows: turn (null first), role, md5 of the text; of
    rows that repeat all but the first are duplicates. Null roles and texts are one space; a role that begins with none of
    s, u, a, or is empty, cannot stay. A null conversation id is an id. Other columns are not read. An empty table gives no rows.
    """
    return _audits(coded_rows(keyed(turns, conv_id, turn, role, text)))


def _audits(coded: DataFrame) -> DataFrame:
    stored = cut_lineage(shares(coded), "turn-shares")
    kind = dict(stored.dtypes)["conv_id"]
    names = ["n_rows", "blank", "duplicate", "truncated", "illegal"]
    whole = stored.where("whole").select("conv_id", *names, "cost", F.array(F.element_at("options", 1)["path"]).alias("parts"))
    # conversations over several tasks: a row for each of these, without paths
    some = stored.where("not whole").select("conv_id", "part", *names, "first", "last", F.transform("options", lambda o: F.struct(o["before"], o["after"], o["cost"], o["rank"])).alias("options"))
    chosen_names = ["conv_id", "part", *names, "cost", "before", "after", "tail"]

    def choose(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])
        cost, path = finish([[tuple(o.values()) for o in r["options"]] for r in rows])
        sums = {c: sum(r[c] for r in rows) for c in names}
        sums["illegal"] += sum(x["last"] + y["first"] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
        out = [
            {"conv_id": r["conv_id"], "part": r["part"], **sums, "cost": cost, "before": b, "after": a, "tail": path[-1] if r is rows[-1] else ""}
            for r, (b, a) in zip(rows, path)
        ]
        return pa.Table.from_pylist(out, schema=pa.schema([(c, t.schema.field("conv_id").type if c == "conv_id" else pa.string() if c == "tail" else pa.int64()) for c in chosen_names]))

    counts = "".join(f", {c} long" for c in names)
    chosen = some.groupBy("conv_id").applyInArrow(choose, f"conv_id {kind}, part long{counts}, cost long, before long, after long, tail string")
    paths = stored.where("not whole").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.explode("options").alias("o"))
    here = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("before") == F.col("o.before")) & (F.col("after") == F.col("o.after"))
    met = chosen.join(paths, here).withColumn("piece", F.struct("part", F.concat("o.path", "tail").alias("path")))
    joined = met.groupBy("conv_id").agg(
        *[F.max(c).alias(c) for c in [*names, "cost"]], F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["path"]).alias("parts")
    )
    return whole.unionByName(joined)


class _Repair:
    """Edits of one conversation, applied row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self.step(), ""

    def step(self) -> str:
        self.state, initial = NEXT[self.state]
        return "user" if initial == "u" else "assistant"

    def row(self, role: str, text: str):
        """The rows that stand for this one."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self.step(), text
        elif edit == "K":
            if role[:1] == "s":
                self.state = 1
            else:
                self.step()
            yield role, text


def repaired(turns: DataFrame, found: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", digest: bool = False) -> DataFrame:
    """``conv_id, place, role, text``: the rows of every repaired conversation; found: its ``audits``, stored.

    With ``digest`` one row a conversation, ``conv_id, sha256``, of the rows as ``role:text`` with line feeds between them, which is
    computed as the rows stream by. Rows stream through a task sorted; only the audit of one conversation is held.
    """
    rows = keyed(turns, conv_id, turn, role, text).select("conv_id", F.lit(1).alias("copy"), "turn", "role", "text", "hash", F.lit(None).cast("array<string>").alias("parts"))
    heads = found.select("conv_id", F.lit(0).alias("copy"), F.lit(None).cast(dict(rows.dtypes)["turn"]).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("hash"), "parts")
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "copy", F.col("turn").asc_nulls_first(), "role", "hash")
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches):
        now, edits, sha, place = None, None, None, 0
        cols: list[list] = [[], [], [], []]

        def put(conv, rows_):
            nonlocal place
            for r, t in rows_:
                if digest:
                    sha.update((("\n" if place else "") + f"{r}:{t}").encode())
                else:
                    for c, v in zip(cols, (conv, place, r, t)):
                        c.append(v)
                place += 1

        def end():
            if edits is not None:
                put(now, edits.inserted())
                if digest:
                    cols[0].append(now)
                    cols[1].append(sha.hexdigest())

        def batch(kind_of):
            arrays = [pa.array(cols[0], kind_of)] + ([pa.array(cols[1], pa.string())] if digest else [pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())])
            for c in cols:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "sha256"] if digest else ["conv_id", "place", "role", "text"])

        kind_of = None
        for whole in batches:
            for b in small(whole):
                kind_of = b.schema.field("conv_id").type
                for conv, copy, r, t, parts in zip(*(b.column(c).to_pylist() for c in ("conv_id", "copy", "role", "text", "parts"))):
                    if copy == 0:
                        end()
                        now, edits, sha, place = conv, _Repair("".join(parts)), hashlib.sha256(), 0
                    else:
                        put(conv, edits.row(r, t))
                yield batch(kind_of)
        if edits is not None:
            end()
            yield batch(kind_of)

    return ordered.mapInArrow(run, f"conv_id {kind}, sha256 string" if digest else f"conv_id {kind}, place long, role string, text string")
