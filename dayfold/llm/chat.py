"""Chat records of many layouts as canonical turns, and the turns as template text with a loss mask.

A record is JSON. The hash of its nested field paths (its fingerprint) selects a declarative mapping, which says where
the turns are. Turns are written with a template whose control strings are escaped inside texts, and can be read back.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How a layout becomes turns. ``paths``: all its field paths. ``each``: path of the list whose items are turns, each with
#: ``role`` and ``text`` (``order``: the field that orders turns kept as records of their own). ``turns``: (role, path)
#: of turns in fields of their own; an absent text is no turn there.
MAPPINGS = [
    {"paths": ["order", "role", "text"], "each": "", "role": "role", "text": "text", "order": "order"},
    {"paths": ["messages[].role", "messages[].content"], "each": "messages", "role": "role", "text": "content"},
    {"paths": ["conversations[].from", "conversations[].value"], "each": "conversations", "role": "from", "text": "value"},
    {"paths": ["prompt", "completion"], "turns": [("user", "prompt"), ("assistant", "completion")]},
    {"paths": ["prompt", "response"], "turns": [("user", "prompt"), ("assistant", "response")]},
    {"paths": ["system", "prompt", "response"], "turns": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
    {"paths": ["instruction", "output"], "turns": [("user", "instruction"), ("assistant", "output")]},
    {"paths": ["instruction", "input", "output"], "turns": [("user", "instruction\ninput"), ("assistant", "output")]},
    {"paths": ["data.question", "data.answer"], "turns": [("user", "data.question"), ("assistant", "data.answer")]},
]
#: Names that some layouts give to the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def paths_of(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; items of a list share one path. An empty object or list is a path itself."""
    if isinstance(value, dict) and value:
        return set().union(*(paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list) and value:
        return set().union(*(paths_of(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode(errors="surrogatepass")).hexdigest()[:16]


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) and name else value
    return value


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: dict) -> list[tuple[int | None, str, str]]:
    """(order, role, text) of a record's turns by ``mapping``."""
    if "each" in mapping:
        items = _at(record, mapping["each"])
        items = items if isinstance(items, list) else [items]
        return [(x.get(mapping["order"]) if "order" in mapping else i, _text(x.get(mapping["role"])), _text(x.get(mapping["text"]))) for i, x in enumerate(items)]
    found = []
    for role, path in mapping["turns"]:
        texts = [t for t in (_at(record, p) for p in path.split("\n")) if t not in (None, "")]
        if texts or "\n" not in path:
            found.append((len(found), role, "\n\n".join(map(_text, texts))))
    return found


_TURN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string())])
_TURN_SQL = "conv_id bigint, turn bigint, role string, text string, layout string"


def _whole(order) -> int | None:
    """``order`` as a whole number, also from text or a float that is one; NULL if it is none, or out of range."""
    if isinstance(order, float):
        order = int(order) if order.is_integer() else None
    elif isinstance(order, str):
        order = int(order) if re.fullmatch(r"[+-]?[0-9]{1,19}", order.strip()) else None
    return order if isinstance(order, int) and not isinstance(order, bool) and -(1 << 63) <= order < 1 << 63 else None


def _clean(text: str | None) -> str | None:
    """``text`` as UTF-8 can hold it."""
    return text if text is None or text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def canonical_turns(records: DataFrame, mappings: list[dict] = MAPPINGS, roles: dict[str, str] = ROLES) -> DataFrame:
    """(conv_id, turn, role, text, layout) of ``records`` (conv_id, record as JSON); layout is the fingerprint.

    A record of an unknown layout, or that is no JSON object, gives one row with NULL role and text and its fingerprint
    ("" if it is none), so that nothing vanishes: filter on ``role is null`` to find what lacks a mapping. An order that is
    no whole number of 64 bits is NULL, and a lone surrogate in a record counts as U+FFFD. Other columns are left out.
    """
    known = {fingerprint(m["paths"]): m for m in mappings}

    def convert(batches):
        for batch in batches:
            rows = []
            for conv, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    value = json.loads(record or "")
                    layout = fingerprint(paths_of(value)) if isinstance(value, dict) else ""
                except (ValueError, RecursionError):  # no JSON, or nested deeper than any known layout
                    layout = ""
                found = turns_of(value, known[layout]) if layout in known else [(None, None, None)]
                rows += [(conv, _whole(order), _clean(roles.get(role, role)), _clean(text), layout) for order, role, text in found]
            columns = zip(*rows, strict=True) if rows else [[]] * len(_TURN)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TURN.types, strict=True)], schema=_TURN)

    return records.select(F.col("conv_id").cast("bigint"), "record").mapInArrow(convert, _TURN_SQL)


# The template. A conversation opens with <s>; a user turn is "[INST] text [/INST]", an assistant turn "text</s>", any
# other "[ROLE]role[TEXT]text[/ROLE]".

_CONTROL = r"(?:/?INST\]|/?ROLE\]|TEXT\]|/?s>)"
_ESCAPE = re.compile(r"([<\[])(\\*)(?=" + _CONTROL + ")")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=" + _CONTROL + ")")
_TOKEN = re.compile(r"[<\[]" + _CONTROL)


def escaped(text: str) -> str:
    """``text`` with one more backslash inside whatever looks like a control string, escaped ones too."""
    return _ESCAPE.sub(r"\1\2\\", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def written(role: str, text: str) -> tuple[str, int, int]:
    """Template text of one turn, and the span in it that counts for the loss (empty but for assistants)."""
    body = escaped(text)
    if role == "assistant":
        return body + "</s>", 0, len(body)
    if role == "user":
        return f"[INST] {body} [/INST]", 0, 0
    return f"[ROLE]{escaped(role)}[TEXT]{body}[/ROLE]", 0, 0


def read_turns(formatted: str):
    """(role, text) of the turns in template text."""
    at = 3 if formatted.startswith("<s>") else 0
    while at < len(formatted):
        token = _TOKEN.search(formatted, at)
        if token[0] == "[INST]" and token.start() == at:
            end = _TOKEN.search(formatted, token.end())
            yield "user", unescaped(formatted[token.end() + 1 : end.start() - 1])
        elif token[0] == "[ROLE]" and token.start() == at:
            middle = _TOKEN.search(formatted, token.end())
            end = _TOKEN.search(formatted, middle.end())
            yield unescaped(formatted[token.end() : middle.start()]), unescaped(formatted[middle.end() : end.start()])
        else:
            end = token
            yield "assistant", unescaped(formatted[at : end.start()])
        at = end.end()


_PIECE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])
_PIECE_SQL = "conv_id bigint, turn bigint, formatted string, loss_start bigint, loss_end bigint"


def format_chats(turns: DataFrame) -> DataFrame:
    """Template text of ``turns`` (conv_id, turn, role, text): one row per turn, in the order of each conversation.

    The rows of one conversation, end to end, are its training text; ``loss_start`` and ``loss_end`` are the span of
    the row that counts for the loss. A conversation is streamed, so one with very many turns needs no memory of its
    size. NULL role or text is empty, rows of equal turn are ordered by role and text, NULL conv_id is a conversation.
    """
    keys = [F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn")]
    rows = turns.select(*keys, *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def write(batches):
        last = ()
        for batch in batches:
            conv, turn, role, text = (c.to_pylist() for c in batch.columns)
            made = []
            for c, r, t in zip(conv, role, text, strict=True):
                body, start, end = written(r, t)
                if last != (c,):
                    body, start, end, last = f"<s>{body}", start + 3, end + 3, (c,)
                made.append((body, start, end) if end > start else (body, 0, 0))
            columns = zip(*made, strict=True) if made else [[]] * 3
            yield pa.record_batch([pa.array(x, t) for x, t in zip((conv, turn, *columns), _PIECE.types, strict=True)], schema=_PIECE)

    return rows.mapInArrow(write, _PIECE_SQL)


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_DIGEST_SQL = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its template text says when it is read back. ``formatted`` as ``format_chats`` gives it,
    with the rows of a conversation in one partition and in order; digests are streamed."""

    def close(conv, n, turns, chars, loss, size):
        return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)

    def read(batches):
        state = None
        for batch in batches:
            done = []
            for conv, _, body, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv or body.startswith("<s>"):
                    if state is not None:
                        done.append(close(*state))
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(body):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                lossy = unescaped(body[start:end])
                state[3] += len(lossy)
                state[4].update(lossy.encode())
                state[5] += len(body)
            yield _digest_batch(done)
        if state is not None:
            yield _digest_batch([close(*state)])

    return formatted.mapInArrow(read, _DIGEST_SQL)


def _digest_batch(rows):
    columns = zip(*rows, strict=True) if rows else [[]] * len(_DIGEST)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _DIGEST.types, strict=True)], schema=_DIGEST)
