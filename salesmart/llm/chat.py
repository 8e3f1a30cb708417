"""Chat formatting with minimum-cost role repair.

A conversation is legal when it is an optional system message, then user and
assistant messages in turn, beginning with the user.  Each given turn keeps its
role or is relabelled, and either begins a message or merges into the message
before; empty messages are inserted where a legal order needs them.  Each of
these has a cost, and dynamic programming over the automaton's states (the role
of the last message) finds the cheapest repair; of equally cheap ones, the one
whose roles come first in the order system, user, assistant at the first turn
where they differ.

The turns are range-partitioned by (conversation, turn), so a conversation of
any length may span partitions.  A partition then summarises its part of a
conversation as a matrix: the cost, and the rank among ties, from every state
before to every state after.  Matrices of one conversation combine from left
to right, which fixes the states at the partition borders; with these each
partition repairs and renders its own turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import land, shuffle_width

ROLES = ("system", "user", "assistant")
SYSTEM, USER, ASSISTANT, START = 0, 1, 2, 3  # states: the role of the last message, or none yet
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "model": "assistant", "gpt": "assistant", "ai": "assistant", "developer": "system"}


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 7
    unknown: int = 1  # giving a role to a turn that has none or an unknown one
    insert: int = 3


@dataclass(frozen=True)
class Template:
    begin: str = "<|im_start|>{role}\n"
    end: str = "<|im_end|>\n"
    join: str = "\n\n"  # between merged turns
    guard: tuple[tuple[str, str], ...] = (("<|im_start|>", "<|im_start |>"), ("<|im_end|>", "<|im_end |>"))

    def clean(self, text: str | None) -> str:
        text = text or ""
        for marker, harmless in self.guard:
            text = text.replace(marker, harmless)
        return text

    def message(self, role: int) -> str:
        return self.begin.format(role=ROLES[role])


# Messages to insert before a message of a role (column) after a state (row); None: not possible.
_BEFORE: dict[tuple[int, int], tuple[int, ...] | None] = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,),
    (SYSTEM, SYSTEM): None, (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
    (USER, SYSTEM): None, (USER, USER): (ASSISTANT,), (USER, ASSISTANT): (),
    (ASSISTANT, SYSTEM): None, (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,),
}


def role_number(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else None


def moves(state: int, role: int | None, costs: Costs) -> list[tuple[int, int, bool]]:
    """(cost, new role, merged) of what may happen to a turn of ``role`` after ``state``; the cheaper of merging and beginning."""
    out = []
    for new in range(3):
        label = 0 if role == new else costs.unknown if role is None else costs.relabel
        before = _BEFORE[state, new]
        begin = None if before is None else label + costs.insert * len(before)
        merge = label + costs.merge if state == new else None
        if merge is not None and (begin is None or merge <= begin):
            out.append((merge, new, True))
        elif begin is not None:
            out.append((begin, new, False))
    return out


def closing(state: int, costs: Costs) -> int:
    """Cost of ending after ``state``: a system message alone needs an empty user message."""
    return costs.insert if state == SYSTEM else 0


class Part:
    """The turns of one conversation in one partition: a step of the automaton for each."""

    def __init__(self, costs: Costs):
        self._moves = {(s, r): moves(s, r, costs) for s in range(4) for r in (0, 1, 2, None)}

    def advance(self, front: dict[int, tuple[int, int]], role: int | None) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[int, bool]]]:
        """One turn: states reached with (cost, rank), and for each the state before and whether it merged."""
        best: dict[int, tuple[int, int, int, bool]] = {}
        for state, (cost, rank) in front.items():
            for more, new, merged in self._moves[state, role]:
                way = (cost + more, rank, state, merged)
                if new not in best or way[:2] < best[new][:2]:
                    best[new] = way
        order = sorted(best, key=lambda new: (best[new][1], new))
        return {new: (best[new][0], order.index(new)) for new in best}, {new: best[new][2:] for new in best}

    def matrix(self, roles: list[int | None]) -> dict[int, dict[int, tuple[int, int]]]:
        """For each state before: the states after with (cost, rank)."""
        fronts = {s: {s: (0, 0)} for s in range(4)}
        for role in roles:
            fronts = {s: self.advance(f, role)[0] for s, f in fronts.items()}
        return fronts

    def path(self, roles: list[int | None], entry: int, exit_: int | None, costs: Costs) -> list[tuple[int, int, bool]]:
        """(state before, new role, merged) of every turn, from ``entry`` to ``exit_`` (None: the best end)."""
        front, backs = {entry: (0, 0)}, []
        for role in roles:
            front, back = self.advance(front, role)
            backs.append(back)
        state = exit_ if exit_ is not None else best_end(front, costs)
        out = []
        for back in reversed(backs):
            before, merged = back[state]
            out.append((before, state, merged))
            state = before
        return out[::-1]


def best_end(front: dict[int, tuple[int, int]], costs: Costs) -> int:
    return min(front, key=lambda s: (front[s][0] + closing(s, costs), front[s][1]))


def border_states(parts: list[dict[int, dict[int, tuple[int, int]]]], costs: Costs) -> list[int]:
    """States before, between and after the parts of one conversation, from the parts' matrices."""
    front, backs = {START: (0, 0)}, []
    for matrix in parts:
        best: dict[int, tuple[int, int, int, int]] = {}
        for state, (cost, rank) in front.items():
            for new, (more, nth) in matrix[state].items():
                way = (cost + more, rank, nth, state)
                if new not in best or way[:2] < best[new][:2]:
                    best[new] = way
        order = sorted(best, key=lambda new: best[new][1:3])
        front, back = {new: (best[new][0], order.index(new)) for new in best}, {new: best[new][3] for new in best}
        backs.append(back)
    states = [best_end(front, costs)]
    for back in reversed(backs):
        states.append(back[states[-1]])
    return states[::-1]


OUT = "new_role string, action string, inserted_before string, inserted_after string, rendered string"
_OUT_NAMES = ["new_role", "action", "inserted_before", "inserted_after", "rendered"]


def render(turns: list[tuple[str | None, str | None]], entry: int, exit_: int | None, last: bool, part: Part, costs: Costs, template: Template) -> list[tuple[str, str, str, str, str]]:
    """The output fields of the turns (role, text) of one part; ``last``: the conversation ends here."""
    roles = [role_number(r) for r, _ in turns]
    rows = []
    for (role, text), own, (before, new, merged) in zip(turns, roles, part.path(roles, entry, exit_, costs), strict=True):
        inserted = () if merged else _BEFORE[before, new]
        action = ("keep" if own == new else "relabel") if not merged else ("merge" if own == new else "relabel+merge")
        if merged:
            shown = template.join
        else:
            shown = template.end if before != START else ""
            shown += "".join(template.message(r) + template.end for r in inserted) + template.message(new)
        rows.append([ROLES[new], action, ",".join(ROLES[r] for r in inserted), "", shown + template.clean(text)])
    if last and rows:
        alone = rows[-1][0] == ROLES[SYSTEM]
        rows[-1][3] = ROLES[USER] if alone else ""
        rows[-1][4] += template.end + (template.message(USER) + template.end if alone else "")
    return [tuple(r) for r in rows]


def _conversations(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """(key, rows) of each conversation of a sorted partition."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if rows and row[0] != key:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield key, rows


def format_chats(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", costs: Costs = Costs(), template: Template = Template()
) -> DataFrame:
    """One row per row of ``df``: conversation, turn, role and the fields of ``OUT``.

    The ``rendered`` parts of a conversation, joined in the order of turn, role
    and xxhash64 of the text, are the whole formatted conversation.  Roles are read without
    case and by ``ALIASES``; a null or other role is unknown.  A null text is
    empty, a null turn comes first, rows that tie in the turn (repeated rows
    too) are turns of their own, and rows with a null conversation make one
    conversation.  A conversation of any length is repaired in parts, by matrices
    of costs between them; of repairs of equal cost the first by the order of
    actions is taken.  Markers of the template within a text are defused.  Other
    columns are not read; an empty table gives an empty result.
    """
    width = shuffle_width(df.sparkSession)
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = ["conv", "turn", "role", "tie"]
    tied = rows.withColumn("tie", F.xxhash64("text"))
    dealt = tied.repartitionByRange(width, *order).select(F.spark_partition_id().alias("part"), *order, "text")
    dealt = land(dealt, "turns")
    part = Part(costs)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The matrices of the first and the last conversation of a partition."""
        first = last = None
        where = None
        for key, turns in _conversations(batches, ["conv", "part", "role"]):
            where = turns[0][1]
            last = (key, turns)
            first = first or last
        ends = [] if first is None else [first] if first is last else [first, last]
        for nth, (key, turns) in enumerate(ends):
            matrix = part.matrix([role_number(t[2]) for t in turns])
            cells = [(where, nth, len(ends), repr(key), s, e, cost, rank) for s, front in matrix.items() for e, (cost, rank) in front.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*cells, strict=True)], ["part", "nth", "ends", "conv", "before", "after", "cost", "rank"])

    ordered = dealt.repartitionById(width, F.col("part")).sortWithinPartitions(*order)
    # Two matrices per partition at most come to the driver, whatever the number of turns.
    cells = ordered.select("conv", "part", "role").mapInArrow(summary, "part bigint, nth bigint, ends bigint, conv string, before bigint, after bigint, cost bigint, rank bigint").collect()
    borders = _borders([c.asDict() for c in cells], costs)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = next((b for b in batches if b.num_rows), None)
        if begun is None:
            return
        types = [begun.schema.field(n).type for n in ("conv", "turn", "role")] + [pa.string()] * len(_OUT_NAMES)

        def done(turns: list[tuple], is_first: bool, is_last: bool) -> pa.RecordBatch:
            here = borders.get(turns[0][4], {})
            entry, exit_ = here.get("first" if is_first else "last", (START, None)) if is_first or is_last else (START, None)
            if is_first and is_last and "last" in here:
                exit_ = here["last"][1]
            shown = render([(t[2], t[3]) for t in turns], entry, exit_, exit_ is None, part, costs, template)
            fields = [*zip(*((t[0], t[1], t[2]) for t in turns), strict=True), *zip(*shown, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(fields, types, strict=True)], ["conv", "turn", "role", *_OUT_NAMES])

        held, first = None, True
        for _, turns in _conversations(chain([begun], batches), ["conv", "turn", "role", "text", "part"]):
            if held is not None:
                yield done(held, first, False)
                first = False
            held = turns
        yield done(held, first, True)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"conv {kinds['conv']}, turn {kinds['turn']}, role {kinds['role']}, {OUT}"
    out = ordered.select("conv", "turn", "role", "text", "part").mapInArrow(repair, schema)
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), *_OUT_NAMES)


def _borders(cells: list[dict], costs: Costs) -> dict[int, dict[str, tuple[int, int | None]]]:
    """By partition: (state before, state after or None at the end) of its first and its last conversation,
    for conversations that span partitions."""
    ends: dict[tuple[int, int], dict] = {}
    for c in cells:
        end = ends.setdefault((c["part"], c["nth"]), {"conv": c["conv"], "ends": c["ends"], "matrix": {}})
        end["matrix"].setdefault(c["before"], {})[c["after"]] = (c["cost"], c["rank"])
    runs: list[list[tuple[int, int]]] = []
    previous = None
    for key in sorted(ends):
        # A conversation goes on where a partition's last is the next one's first.
        if previous is not None and key[0] != previous[0] and key[1] == 0 and ends[key]["conv"] == ends[previous]["conv"]:
            runs[-1].append(key)
        else:
            runs.append([key])
        previous = key
    out: dict[int, dict[str, tuple[int, int | None]]] = {}
    for run in runs:
        if len(run) < 2:
            continue
        states = border_states([ends[k]["matrix"] for k in run], costs)
        for i, (where, nth) in enumerate(run):
            after = states[i + 1] if i + 1 < len(run) else None
            only = ends[where, nth]["ends"] == 1
            for name in ["first", "last"] if only else ["first" if nth == 0 else "last"]:
                out.setdefault(where, {})[name] = (states[i], after)
    return out
