"""Chat formatting: records of many layouts become canonical turns by the fingerprint of their schema, and turns become marked text.

The nested field paths of a record, hashed, select a declarative mapping. A template marks each turn; control strings inside texts are escaped
so that the marks alone tell where turns begin and end, and the texts can be read back.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, functions as F

from recordkit.llm.common import map_rows

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
# A control string begins with "<|". One more backslash goes between the two signs, wherever they stand with any number of them.
OPEN, OPENED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


# ---------------------------------------------------------------- layouts


def field_paths(value: Any, prefix: str = "") -> set[str]:
    """Nested field paths of a record: names joined by dots, ``[]`` for the items of a list. Dots and brackets in names are escaped."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            own = re.sub(r"[\\.\[\]]", lambda m: "\\" + m.group(), name)
            found |= field_paths(inner, f"{prefix}.{own}" if prefix else own)
        return found or {prefix + "{}"}
    if isinstance(value, list):
        return set().union(*[field_paths(v, prefix + "[]") for v in value]) if value else {prefix + "[]"}
    return {prefix}


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(errors="surrogatepass"), digest_size=16).hexdigest()


@dataclass(frozen=True)
class Part:
    """One or more turns of a layout. ``text`` and ``role`` are field paths; without a role field, ``says`` names the role. With
    ``items``, a list of objects, both are fields of each item. ``text`` may name several fields, joined by ``between``
    where they are neither null nor empty. ``roles`` renames roles."""

    text: tuple[str, ...]
    role: str | None = None
    says: str = ""
    items: str | None = None
    between: str = "\n"
    roles: dict[str, str] = field(default_factory=dict)

    def needed(self) -> set[str]:
        lead = f"{self.items}[]." if self.items else ""
        return {lead + name for name in (*self.text, *([self.role] if self.role else []))}


@dataclass(frozen=True)
class Layout:
    """The parts of a record in their order, fields that may be missing, and fields that may stand beside and are not used."""

    name: str
    parts: tuple[Part, ...]
    optional: tuple[str, ...] = ()
    beside: tuple[str, ...] = ()

    def fingerprints(self) -> Iterator[str]:
        """One for each set of fields that a record of the layout may have."""
        must = set().union(*[p.needed() for p in self.parts]) - set(self.optional)
        free = [*self.optional, *self.beside]
        for n in range(len(free) + 1):
            for some in itertools.combinations(free, n):
                yield fingerprint(must | set(some))
        lists = {p.items for p in self.parts if p.items}
        if len(self.parts) == 1 and lists:  # a list without items
            for n in range(len(self.beside) + 1):
                for some in itertools.combinations(self.beside, n):
                    yield fingerprint({f"{next(iter(lists))}[]", *some})


SHARED_ROLES = {"human": "user", "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
LAYOUTS = (
    Layout("turn", (Part(("text",), role="role"),)),
    Layout("messages", (Part(("content",), role="role", items="messages", roles=SHARED_ROLES),), beside=("id", "source")),
    Layout("from_value", (Part(("value",), role="from", items="conversations", roles=SHARED_ROLES),), beside=("id", "source")),
    Layout("prompt_response", (Part(("system",), says="system"), Part(("prompt",), says="user"), Part(("response",), says=ASSISTANT)), optional=("system",), beside=("id", "source")),
    Layout("prompt_completion", (Part(("system",), says="system"), Part(("prompt",), says="user"), Part(("completion",), says=ASSISTANT)), optional=("system",), beside=("id", "source")),
    Layout("instruction", (Part(("instruction", "input"), says="user"), Part(("output",), says=ASSISTANT)), optional=("input",), beside=("id", "source")),
    Layout("question_answer", (Part(("question.text",), says="user"), Part(("answer.text",), says=ASSISTANT)), beside=("id", "source")),
)


def by_fingerprint(layouts: Iterable[Layout]) -> dict[str, Layout]:
    """The layout of each fingerprint; two layouts with a fingerprint in common raise an error."""
    out: dict[str, Layout] = {}
    for layout in layouts:
        for mark in layout.fingerprints():
            if out.setdefault(mark, layout) is not layout:
                raise ValueError(f"{layout.name} and {out[mark].name} may look alike")
    return out


def at_path(record: Any, path: str) -> str | None:
    """The text at a path of names; other scalars as JSON text, nothing if a name is missing or null."""
    for name in path.split("."):
        if not isinstance(record, dict) or name not in record:
            return None
        record = record[name]
    return whole_characters(record) if record is None or isinstance(record, str) else json.dumps(record, ensure_ascii=False)


def whole_characters(text: str | None) -> str | None:
    """The text with U+FFFD for each half of a surrogate pair that stands alone, which JSON may hold and no column can."""
    if text is None or not any("\ud800" <= c <= "\udfff" for c in text):
        return text
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def turns_of(record: Any, layout: Layout) -> Iterator[tuple[str, str]]:
    for part in layout.parts:
        whole = at_items(record, part.items) if part.items else [record]
        for one in whole:
            found = [at_path(one, name) for name in part.text]
            if not part.items and part.role is None and len(part.text) == 1 and part.text[0] in layout.optional and found[0] is None:
                continue
            text = found[0] or "" if len(found) == 1 else part.between.join(t for t in found if t)
            role = at_path(one, part.role) or "" if part.role else part.says
            yield part.roles.get(role, role), text


def at_items(record: Any, path: str) -> list:
    for name in path.split("."):
        record = record[name]
    return record


def _turns(rows: Iterator[tuple], known: dict[str, Layout]) -> Iterator[tuple]:
    for conv_id, place, record in rows:
        try:
            given = json.loads(record) if record else None
        except ValueError:
            given = None
        if not isinstance(given, dict):
            yield conv_id, place, -1, None, None, None, None
            continue
        mark = fingerprint(field_paths(given))
        layout = known.get(mark)
        if layout is None:
            yield conv_id, place, -1, None, None, mark, None
            continue
        for i, (role, text) in enumerate(turns_of(given, layout)):
            yield conv_id, place, i, role, text, mark, layout.name


def canonical_turns(records: DataFrame, layouts: Iterable[Layout] = LAYOUTS, id_column: str = "conv_id", place_column: str = "place", record_column: str = "record") -> DataFrame:
    """``conv_id``, ``place``, ``item`` (from 0 within the record), ``role``, ``text``, ``fingerprint`` and ``layout`` for each turn.

    ``record`` is a JSON object; the hash of its nested field paths selects the layout, and the layout says where roles and texts are.
    A conversation may lie in several records, ordered by ``place``. A record that is null, no JSON object, or of an unknown layout gives one
    row with item -1, null role and text, and its fingerprint if it has one, so none is lost unseen. Null roles and texts are empty; numbers
    and truth values in a text's place are JSON text. A list without items gives no turns. Repeated rows give repeated turns. Other columns are not
    read. No rows give no rows.
    """
    ids, places = (records.schema[c].dataType.simpleString() for c in (id_column, place_column))
    given = records.select(F.col(id_column).alias("conv_id"), F.col(place_column).alias("place"), F.col(record_column).alias("record"))
    schema = f"conv_id {ids}, place {places}, item int, role string, text string, fingerprint string, layout string"
    return map_rows(given, ["conv_id", "place", "record"], partial(_turns, known=by_fingerprint(layouts)), schema)


# ---------------------------------------------------------------- template


def escaped(text: str) -> str:
    """The text without a control string, so that it can be undone."""
    return OPEN.sub(r"<\\\1|", text) if "<" in text else text


def unescaped(text: str) -> str:
    return OPENED.sub(r"<\1|", text) if "<" in text else text


def escaped_role(role: str) -> str:
    """As ``escaped``, on one line."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), unescaped(role), flags=re.S)


def marked(role: str, text: str) -> tuple[str, int]:
    """A turn with its marks, and the code point at which its text begins."""
    head = f"{START}{escaped_role(role)}\n"
    return f"{head}{escaped(text)}{END}\n", len(head)


def _format(rows: Iterator[tuple], learned: frozenset[str]) -> Iterator[tuple]:
    for conv_id, place, item, role, text in rows:
        whole, start = marked(role or "", text or "")
        loss = (start, len(whole) - len(END) - 1) if (role or "") in learned else (0, 0)
        yield conv_id, place, item, whole, *loss


def format_turns(turns: DataFrame, learned: Iterable[str] = (ASSISTANT,), id_column: str = "conv_id", place_column: str = "place", item_column: str = "item") -> DataFrame:
    """``conv_id``, ``place``, ``item``, ``formatted``, ``loss_from`` and ``loss_to`` for each turn with its ``role`` and ``text``.

    A conversation's training text is that of its turns in the order of ``place`` (null first) and ``item``, nothing between. The loss mask covers the code
    points ``loss_from`` up to ``loss_to`` of ``formatted``: the texts of ``learned`` roles, both 0 for others. A conversation is never gathered, so one
    of any length can be formatted; each turn is handled whole. Null roles and texts are empty. Repeated rows give repeated turns. Other
    columns are not read. No rows give no rows.
    """
    kinds = [turns.schema[c].dataType.simpleString() for c in (id_column, place_column, item_column)]
    given = turns.select(F.col(id_column).alias("conv_id"), F.col(place_column).alias("place"), F.col(item_column).alias("item"), "role", "text")
    schema = f"conv_id {kinds[0]}, place {kinds[1]}, item {kinds[2]}, formatted string, loss_from int, loss_to int"
    return map_rows(given, ["conv_id", "place", "item", "role", "text"], partial(_format, learned=frozenset(learned)), schema)


class Reader:
    """Reads training text as it comes, in pieces that need not end where turns do."""

    def __init__(self) -> None:
        self.open = ""

    def turns(self, piece: str) -> Iterator[tuple[str, str]]:
        """The turns that the piece completes."""
        self.open += piece
        while (end := self.open.find(END + "\n")) >= 0:
            turn, self.open = self.open[:end], self.open[end + len(END) + 1 :]
            if not turn.startswith(START):
                raise ValueError("text between turns")
            role, _, text = turn[len(START) :].partition("\n")
            yield unescaped_role(role), unescaped(text)

    def close(self) -> None:
        if self.open:
            raise ValueError("a turn without its end")


class Digest:
    """What one conversation's training text says, read back from it."""

    def __init__(self) -> None:
        self.reader, self.turns, self.loss = Reader(), hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, start: int, end: int) -> None:
        for role, text in self.reader.turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1
        learned = unescaped(formatted[start:end])
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.loss_chars += len(learned)
        self.chars += len(formatted)

    def row(self) -> tuple:
        self.reader.close()
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, own in itertools.groupby(rows, key=lambda r: r[0]):
        digest = Digest()
        for _, formatted, start, end in own:
            digest.add(formatted, start, end)
        yield conv_id, *digest.row()


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256`` and ``formatted_chars`` for each conversation of ``format_turns``.

    The marks of the text alone tell its turns, and the loss mask its learned text, so equal digests show that the format keeps both. Turns
    are read in order as a stream: no task holds more than one, and the digests' order allows no other split of a conversation. Turns
    of equal place and item follow by their text. Rows with a null id are one conversation. No rows give no rows.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place", "item", "formatted")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_rows(ordered, ["conv_id", "formatted", "loss_from", "loss_to"], _digests, schema)
