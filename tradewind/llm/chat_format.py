"""Chat formatting: records of many layouts to canonical turns, and turns to one template with a loss mask.

1. Layouts. A record is a JSON object. The paths of its nested fields (array elements
   share one path), as far as any layout names them, are hashed; the hash selects a
   declarative mapping that says where conversation, order, role and text stand. A
   path that no layout names (a title, a date) does not change the fingerprint.
   Records whose fingerprint no mapping has come out with `layout` null, their
   fingerprint and no turns, so that nothing is lost without trace.
2. Turns. One row per turn: conversation, order, role, text. Tables with a row per
   turn, prompt and answer, instruction and input and output, and message lists all
   end here, whatever their field names and role names.
3. Template. Each turn is marked by control strings. Control strings inside texts
   are broken by a backslash behind their first character and backslashes are
   doubled, which `unescape` takes back. The loss mask is a list of stretches of the
   formatted text: the text of each assistant turn, without its marks.

Rows move once, by conversation, and each task writes its conversations in order
while they stream by: a conversation of more than `PART` characters goes into
several rows, cut between turns, so that no task holds a whole one. `read_back`
parses the written rows as they are; only conversations in several parts move again.

A null or missing text or role is empty. A message that is no object, or content that
is no text, stands as its JSON text. Turns of one conversation stand by `turn` (null
first), then role and text; equal rows are equal turns. A null conversation is one
conversation of its own. Half surrogates become U+FFFD. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.llm.common import Columns, map_columns

PART = 1 << 20
ROWS = 2_000  # turns or conversations of one output batch


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    `fixed` pairs a role with the path of its text, in the order of the turns. `each` names a list
    (empty: the record itself) and, inside its elements, the paths of role and text. `order` is the
    path of a turn number. `optional` paths may be missing. `roles` translates names.
    """

    name: str
    fixed: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    order: str | None = None
    optional: tuple[str, ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)

    def paths(self) -> frozenset[str]:
        """All field paths of a full record."""
        named = [path for _, path in self.fixed] + ([self.order] if self.order else [])
        if self.each:
            inside = f"{self.each[0]}[]." if self.each[0] else ""
            named += [inside + p for p in self.each[1:]]
        return frozenset(named)


# fixed values: the layouts in which public instruction sets are published
LAYOUTS = (
    Layout("turn_rows", each=("", "role", "text"), order="turn"),
    Layout("prompt_completion", fixed=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("prompt_response", fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout("question_answer", fixed=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", fixed=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("instruction_only", fixed=(("user", "instruction"), ("assistant", "output"))),
    Layout("messages", fixed=(("system", "system"),), each=("messages", "role", "content"), optional=("system",)),
    Layout("data_messages", each=("data.messages", "role", "content")),
    Layout("from_value", fixed=(("system", "system"),), each=("conversations", "from", "value"), optional=("system",),
           roles={"human": "user", "gpt": "assistant"}),
)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:32]


class Registry:
    """Layouts by the fingerprint of the paths they name; two layouts must not share one."""

    def __init__(self, layouts: Sequence[Layout] = LAYOUTS) -> None:
        self.known: frozenset[str] = frozenset(chain.from_iterable(x.paths() for x in layouts))
        self.by_print: dict[str, Layout] = {}
        for layout in layouts:
            for size in range(len(layout.optional) + 1):
                for left_out in combinations(layout.optional, size):
                    key = fingerprint(layout.paths() - set(left_out))
                    if key in self.by_print:
                        raise ValueError(f"{layout.name} and {self.by_print[key].name} have the same fields")
                    self.by_print[key] = layout

    def print_of(self, record: object) -> str:
        return fingerprint(self.known.intersection(field_paths(record)))


def field_paths(value: object) -> set[str]:
    """Paths of all fields of a parsed record, with [] for the elements of a list."""
    found, todo = set(), [("", value)]
    while todo:
        at, x = todo.pop()
        if isinstance(x, dict):
            for name, inner in x.items():
                path = f"{at}.{name}" if at else name
                found.add(path)
                todo.append((path, inner))
        elif isinstance(x, list):
            todo += [(f"{at}[]", inner) for inner in x]
    return found


def _at(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _as_text(value: object) -> str:
    text = "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return text.encode("utf-8", "replace").decode("utf-8") if any("\ud800" <= c <= "\udfff" for c in text) else text


def turns_of(record: object, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of a record, in order."""
    turns = [(role, _at(record, path)) for role, path in layout.fixed if path not in layout.optional or _at(record, path) is not None]
    if layout.each:
        where, role, text = layout.each
        items = _at(record, where) if where else [record]
        for item in items if isinstance(items, list) else []:
            turns.append((_at(item, role), _at(item, text)) if isinstance(item, dict) else ("", item))
    named = [(_as_text(role), _as_text(text)) for role, text in turns]
    return [(layout.roles.get(role, role), text) for role, text in named]


def _parsed(record: str | None) -> object:
    try:
        return json.loads(record or "null")
    except ValueError:
        return None


def canonical_turns(records: DataFrame, registry: Registry | None = None) -> DataFrame:
    """`conv_id`, `turn`, `place`, `role`, `text`, `layout` and `fingerprint` from `conv_id` and `record`, a JSON text.

    A record without turns, or of an unknown layout, is one row with role, text and place null.
    """
    registry = registry or Registry()
    names = ("conv_id", "turn", "place", "role", "text", "layout", "fingerprint")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for at in range(0, len(batch["record"]), ROWS):
                ids, raw = (batch[k].slice(at, ROWS) for k in ("conv_id", "record"))
                rows: list[tuple] = []
                for i, text in enumerate(raw.to_pylist()):
                    record = _parsed(text)
                    key = registry.print_of(record)
                    layout = registry.by_print.get(key)
                    found = turns_of(record, layout) if layout else []
                    order = _at(record, layout.order) if layout and layout.order else None
                    order = order if isinstance(order, int) else None
                    name = layout.name if layout else None
                    rows += [(i, order, k, *turn, name, key) for k, turn in enumerate(found)] or [(i, order, None, None, None, name, key)]
                out = dict(zip(names, zip(*rows)))
                yield out | {"conv_id": ids.take(pa.array(out["conv_id"]))}

    kind = records.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, turn bigint, place int, role string, text string, layout string, fingerprint string"
    return map_columns(records.select("conv_id", F.col("record").cast("string").alias("record")), ddl, task)


@dataclass(frozen=True)
class Template:
    """Marks of the turns. Roles without marks of their own get their name, escaped, into `other`."""

    marks: Mapping[str, tuple[str, str]]
    other: tuple[str, str, str]  # before the name, behind it, behind the text
    learned: str = "assistant"

    def controls(self) -> list[str]:
        """The control strings, longest first: what a text must not hold as it is."""
        strings = {s.strip() for pair in self.marks.values() for s in pair} | {s.strip() for s in self.other}
        return sorted((s for s in strings if len(s) > 1), key=lambda s: (-len(s), s))

    def _heads(self) -> re.Pattern:
        return re.compile("(?=" + "|".join(map(re.escape, self.controls())) + ")(.)", re.S)

    def escape(self, text: str) -> str:
        return self._heads().sub(r"\1\\", text.replace("\\", "\\\\")) if any(c[0] in text for c in self.controls()) or "\\" in text else text

    def escape_name(self, role: str) -> str:
        return self.escape(role).replace(self.other[1][0], "\\" + self.other[1][0])

    def turn(self, role: str, text: str) -> tuple[str, str, str]:
        """What stands before the text, the text, and what stands behind it."""
        if role in self.marks:
            begin, end = self.marks[role]
        else:
            begin, end = self.other[0] + self.escape_name(role) + self.other[1], self.other[2]
        return begin, self.escape(text), end

    def pattern(self) -> re.Pattern:
        """One formatted turn; the groups tell role and text."""
        cases = [
            f"{re.escape(begin)}(?P<t{k}>.*?){re.escape(end)}" for k, (begin, end) in enumerate(self.marks.values())
        ]
        before, behind, end = map(re.escape, self.other)
        name = rf"(?P<name>(?:[^\\{behind[:2] if behind[0] == chr(92) else behind[0]}]|\\.)*)"
        return re.compile("|".join([*cases, f"{before}{name}{behind}(?P<other>.*?){end}"]), re.S)

    def parse(self, formatted: str) -> list[tuple[str, str, int, int]]:
        """Role, text, first and last place of the (escaped) text of every turn of a formatted text."""
        pattern, roles, at, turns = self.pattern(), list(self.marks), 0, []
        while at < len(formatted):
            found = pattern.match(formatted, at)
            if not found:
                raise ValueError(f"no turn at character {at}")
            which = found.lastgroup
            role = unescape(found["name"]) if which == "other" else roles[int(which[1:])]
            turns.append((role, unescape(found[which]), *found.span(which)))
            at = found.end()
        return turns


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


# fixed values: the marks of a widely used chat template, and one for any other role
INST = Template(
    {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")},
    ("[ROLE ", "] ", " [/ROLE]"),
)


def write_formatted(turns: DataFrame, path: str, template: Template = INST, part: int = PART) -> None:
    """Write `conv_id`, `part`, `whole`, `formatted` and `loss` (stretches of `formatted`: `start`, `length`) as Parquet.

    `part` counts the rows of a conversation; `whole` says that the row holds all of it.
    """

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        names = ("conv_id", "part", "whole", "formatted", "loss")
        ready: list[tuple] = []
        pieces: list[str] = []
        loss: list[dict] = []
        size = count = held = 0
        now: object = None
        started = False

        def flush(ends: bool) -> None:
            nonlocal pieces, loss, size, count, held
            ready.append((now, count, ends and count == 0, "".join(pieces), loss))
            pieces, loss, size, count, held = [], [], 0, 0 if ends else count + 1, held + size

        for batch in batches:
            for conv, role, text in zip(*(batch[k].to_pylist() for k in ("conv_id", "role", "text"))):
                if started and conv != now:
                    flush(True)
                elif size >= part:
                    flush(False)
                now, started = conv, True
                if len(ready) >= ROWS or held >= PART:
                    yield dict(zip(names, zip(*ready)))
                    ready, held = [], 0
                begin, body, end = template.turn(role, text)
                if role == template.learned:
                    loss.append({"start": size + len(begin), "length": len(body)})
                pieces += (begin, body, end)
                size += len(begin) + len(body) + len(end)
        if started:
            flush(True)
            yield dict(zip(names, zip(*ready)))

    known = turns.where("role IS NOT NULL").select("conv_id", "turn", "place", "role", F.coalesce("text", F.lit("")).alias("text"))
    ordered = known.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "place", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, part bigint, whole boolean, formatted string, loss array<struct<start:bigint,length:bigint>>"
    map_columns(ordered.select("conv_id", "role", "text"), ddl, task).write.mode("overwrite").parquet(path)


def read_formatted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parsed_turns(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """`conv_id`, `part`, `place`, `role` and `text` of every turn, read from formatted rows."""

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        for batch in batches:
            for k, (part, text) in enumerate(zip(batch["part"].to_pylist(), batch["formatted"].to_pylist())):
                found = template.parse(text)
                if found:
                    roles, texts = zip(*(t[:2] for t in found))
                    ids = batch["conv_id"].take(pa.array([k] * len(found)))
                    yield {"conv_id": ids, "part": [part] * len(found), "place": list(range(len(found))), "role": roles, "text": texts}

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_columns(formatted.select("conv_id", "part", "formatted"), f"conv_id {kind}, part bigint, place int, role string, text string", task)


def read_back(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """Per conversation what its formatted rows hold: turns and learned text, as counts and SHA-256 digests.

    Digests are carried on from part to part, so a conversation of any length needs the memory of one part.
    """
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def task(batches: Iterator[Columns]) -> Iterator[dict]:
        now: object = None
        sums: list | None = None
        ready: list[tuple] = []

        def close() -> None:
            ready.append((now, sums[0], sums[1].hexdigest(), sums[2], sums[3].hexdigest(), sums[4]))

        for batch in batches:
            for conv, text, loss in zip(*(batch[k].to_pylist() for k in ("conv_id", "formatted", "loss"))):
                if sums is None or conv != now:
                    if sums is not None:
                        close()
                    now, sums = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in template.parse(text):
                    sums[0] += 1
                    sums[1].update(f"{role}\n{said}\n".encode())
                for stretch in loss:
                    said = unescape(text[stretch["start"]:stretch["start"] + stretch["length"]])
                    sums[2] += len(said)
                    sums[3].update(said.encode())
                sums[4] += len(text)
            if ready:
                yield dict(zip(names, zip(*ready)))
                ready = []
        if sums is not None:
            close()
            yield dict(zip(names, zip(*ready)))

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    wanted = ["conv_id", "formatted", "loss"]
    whole = map_columns(formatted.where("whole").select(*wanted), ddl, task)
    pieces = formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.unionByName(map_columns(pieces.select(*wanted), ddl, task))


def as_records(rows: DataFrame, fields: Sequence[str], key: str = "conv_id") -> DataFrame:
    """`conv_id` and the named columns as a JSON `record`; null fields stay fields."""
    body: Column = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(F.col(key).alias("conv_id"), body.alias("record"))
