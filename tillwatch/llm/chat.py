"""Chat formatting by schema fingerprints.

A record is a JSON object in one of several layouts. The hash of its nested field paths selects a
declarative mapping, and the mapping yields canonical turns; a record of unknown layout is reported,
never guessed at. Turns are then written under a template that escapes control strings reversibly and
keeps a loss mask over the assistant's texts.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import part_count, slices

CONTROL = re.compile(r"\\|###|</turn>")
ESCAPED = re.compile(r"\\(\\|###|</turn>)")
END = " </turn>\n"
TURN = re.compile(r"### ([^\n]*?): ((?:[^\\<]|\\.|<(?!/turn>))*) </turn>\n", re.DOTALL)


def field_paths(value, prefix: str = "") -> set[str]:
    """Paths of the leaves of nested JSON; items of a list share one path. Nulls have no path."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{prefix}.{k}") for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{prefix}[]") for v in value))
    return set() if value is None else {prefix}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps what a conversation needs.

    ``turns``: path of the list of turns, or "" if the record is itself one turn, with the paths of role
    and text inside it. ``fixed``: (role, path) pairs in turn order, for layouts without a list.
    ``optional``: paths that a record may lack; each choice of them has a fingerprint of its own.
    """

    name: str
    conv: str
    turns: str | None = None
    turn: str | None = None
    role: str | None = None
    text: str | None = None
    fixed: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = field(default_factory=frozenset)
    other: tuple[str, ...] = ()

    def paths(self) -> set[str]:
        found = {f".{self.conv}", *(f".{p}" for p in self.other)}
        if self.turn:
            found.add(f".{self.turn}")
        if self.turns is not None:
            inside = f".{self.turns}[]." if self.turns else "."
            found |= {inside + self.role, inside + self.text}
        return found | {f".{p}" for _, p in self.fixed}

    def fingerprints(self) -> Iterator[str]:
        paths, optional = self.paths(), [f".{p}" for p in self.optional]
        for count in range(len(optional) + 1):
            for left_out in itertools.combinations(optional, count):
                yield fingerprint(paths - set(left_out))


LAYOUTS = (
    Layout(
        "turn rows", "conv_id", turns="", turn="turn", role="role", text="text",
        optional=frozenset({"conv_id", "turn", "role", "text"}),
    ),
    Layout(
        "messages", "conv_id", turns="messages", role="role", text="content",
        optional=frozenset({"conv_id", "messages[].role", "messages[].content"}),
    ),
    Layout(
        "from and value", "id", turns="conversations", role="from", text="value",
        optional=frozenset({"id", "conversations[].from", "conversations[].value"}),
    ),
    Layout(
        "prompt", "conv_id", fixed=(("user", "prompt"), ("assistant", "response")),
        optional=frozenset({"conv_id", "response"}),
    ),
    Layout(
        "instruction", "conv_id",
        fixed=(("system", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=frozenset({"conv_id", "input", "output"}),
    ),
)

ROLES = {"human": "user", "gpt": "assistant"}
"""Names of roles in the "from and value" layout."""


def by_fingerprint(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """The first layout of the list has a fingerprint that two of them share."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        for print_ in layout.fingerprints():
            found.setdefault(print_, layout)
    return found


def _inside(value, path: str):
    for key in path.split(".") if path else ():
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _string(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(data: dict, layout: Layout) -> Iterator[tuple[int | None, int | None, str, str]]:
    """Conversation, turn, role and text of each turn of a record."""
    conv = _inside(data, layout.conv)
    if layout.turns is None:
        # Turn numbers stay what they are where an optional field is missing.
        for n, (role, path) in enumerate(layout.fixed):
            if (text := _inside(data, path)) is not None:
                yield conv, n, role, _string(text)
        return
    items = _inside(data, layout.turns) if layout.turns else [data]
    for n, item in enumerate(items or []):
        number = _inside(data, layout.turn) if layout.turn else n
        role = _string(_inside(item, layout.role))
        role = ROLES.get(role, role) if layout.name == "from and value" else role
        yield conv, number, role, _string(_inside(item, layout.text))


def _whole(value) -> int | None:
    """A JSON number as a 64-bit integer, if it is one."""
    if isinstance(value, float) and value.is_integer():
        value = int(value)
    if isinstance(value, int) and not isinstance(value, bool) and -(2**63) <= value < 2**63:
        return value
    return None


def canonical_turns(
    records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS, id_type: str = "long"
) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``role``, ``text``, ``layout``, ``fingerprint``.

    Role and text are never null: what is missing is empty. Conversation and turn stay null where the
    record lacks them. With ``id_type`` ``string`` any JSON value is an id (a string as it is, others as JSON text); with
    ``long`` a record whose id is no 64-bit integer counts as one of unknown layout. Turn numbers that are no
    such integers are null. A record that is null, no JSON object or of unknown layout gives one row with a
    null ``layout`` and an empty text, for :func:`unmapped`. Repeated records give repeated turns. An
    empty table gives no rows.
    """

    if id_type not in ("long", "string"):
        raise ValueError("ids are long or string")

    def typed(conv):
        if conv is None or id_type == "long":
            return _whole(conv)
        return _string(conv)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = by_fingerprint(layouts)
        for part in slices(batches, "record"):
            rows = []
            for line in part.column("record").to_pylist():
                try:
                    data = json.loads(line) if line is not None else None
                except ValueError:
                    data = None
                if not isinstance(data, dict):
                    rows.append((None, None, "", "", None, None))
                    continue
                print_ = fingerprint(field_paths(data))
                if (layout := known.get(print_)) is None:
                    rows.append((None, None, "", "", None, print_))
                    continue
                for conv, number, role, text in turns_of(data, layout):
                    if conv is not None and typed(conv) is None:
                        rows.append((None, None, "", "", None, print_))
                        break
                    rows.append((typed(conv), _whole(number), role, text, layout.name, print_))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = (pa.int64() if id_type == "long" else pa.string(), pa.int64(), *[pa.string()] * 4)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=["conv_id", "turn", "role", "text", "layout", "fingerprint"],
                )

    return records.select(F.col(record_col).cast("string").alias("record")).mapInArrow(
        run, f"conv_id {id_type}, turn long, role string, text string, layout string, fingerprint string"
    )


def unmapped(turns: DataFrame) -> DataFrame:
    """Number of records by unknown fingerprint (null: no JSON object)."""
    return turns.where("layout IS NULL").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"))


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def role_name(role: str) -> str:
    """Role as the template shows it: common roles capitalised, others encoded after "="."""
    return role.capitalize() if re.fullmatch("[a-z]+", role) else "=" + quote(role, safe="")


def role_of(name: str) -> str:
    return unquote(name[1:]) if name.startswith("=") else name.lower()


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn under the template, with start and end (code points) of its text under the loss mask."""
    head, body = f"### {role_name(role)}: ", escape(text)
    start = len(head)
    return head + body + END, start, start + len(body) if role == "assistant" else start


def format_turns(turns: DataFrame) -> DataFrame:
    """``formatted``, ``loss_start`` and ``loss_end`` of each turn, beside ``conv_id`` and its order.

    A formatted conversation is its turns' strings one after the other; turns are kept apart so that a
    conversation of any length is never held whole. Start equals end where there is no loss. Turns of
    equal number are ordered by role, then text. Null role or text: empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            pairs = zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)
            made = list(zip(*(format_turn(role, text) for role, text in pairs), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("conv_id", "turn", "role", "text")),
                    pa.array(made[0], pa.string()),
                    pa.array(made[1], pa.int64()),
                    pa.array(made[2], pa.int64()),
                ],
                names=["conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end"],
            )

    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")),
    )
    # In the order of the conversation, so that what comes out can be written and read in order.
    ordered = rows.repartition(part_count(turns.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, turn long, role string, text string, formatted string, "
        "loss_start long, loss_end long"
    )
    return ordered.mapInArrow(run, schema).drop("role", "text")


def parse_formatted(text: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the text's span of every turn of a formatted string."""
    found, at = [], 0
    while at < len(text):
        match = TURN.match(text, at)
        if match is None:
            raise ValueError(f"no turn at {at}: {text[at : at + 40]!r}")
        found.append((role_of(match[1]), unescape(match[2]), match.start(2), match.end(2)))
        at = match.end()
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, from its formatted turns alone and in the order they come in.

    ``formatted`` is the output of :func:`format_turns`, whose partitions hold whole conversations in
    order. A conversation is streamed; only hashes and counts of it are held.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        now, turns, loss, counts, done = nothing, None, None, [0, 0, 0], []

        def close() -> None:
            if now is not nothing:
                done.append((now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def flush() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*done, strict=True)
            out = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(out, names=names)

        for part in slices(batches, "formatted"):
            kind = part.column("conv_id").type
            columns = (part.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, text, start, end in zip(*columns, strict=True):
                if now is nothing or conv != now:
                    close()
                    now, counts = conv, [0, 0, 0]
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse_formatted(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    counts[0] += 1
                masked = unescape(text[start:end])
                loss.update(masked.encode())
                counts[1] += len(masked)
                counts[2] += len(text)
            if done:
                yield flush()
        close()
        if done:
            yield flush()

    type_ = formatted.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {type_}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    columns = ("conv_id", "formatted", "loss_start", "loss_end")
    return formatted.select(*columns).mapInArrow(run, schema)
