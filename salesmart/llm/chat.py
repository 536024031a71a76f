"""Chat formatting: layouts found by schema fingerprint, one template, reversible escapes.

A layout is recognised by hashing its sorted nested field paths; the hash selects a declared mapping
into canonical turns (conversation, turn, role, text). Turns are then written into one template:

    ### role: text</turn>

Inside roles and texts a backslash precedes every backslash, ``#`` and ``<`` (and ``:`` in roles), so no
text can hold a control string, and removing that backslash gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesmart.llm.tasks import ship

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
CANONICAL = "conv_id long, turn long, role string, text string"


def fingerprint(paths) -> str:
    """Hash of the sorted nested field paths, such as ``messages[].role``."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Paths of all leaves of a schema; ``[]`` marks a list."""
    if isinstance(kind, T.StructType):
        return [path for f in kind.fields for path in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


@dataclass(frozen=True)
class Layout:
    """``turns`` is SQL for a list of (role, text) structs; None means that each row is one turn."""

    name: str
    paths: tuple[str, ...]
    turns: str | None

    @property
    def key(self) -> str:
        return fingerprint(self.paths)


def _pair(role: str, text: str) -> str:
    return f"named_struct('role', '{role}', 'text', {text})"


LAYOUTS = (
    Layout("rows", ("turn", "role", "text"), None),
    Layout("messages", ("messages[].role", "messages[].content"), "transform(filter(messages, x -> x IS NOT NULL), m -> named_struct('role', m.role, 'text', m.content))"),
    Layout(
        "from_value",
        ("conversations[].from", "conversations[].value"),
        "transform(filter(conversations, x -> x IS NOT NULL), m -> named_struct('role', CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END, 'text', m.value))",
    ),
    Layout("prompt_response", ("prompt", "response"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'response')})"),
    Layout("prompt_completion", ("prompt", "completion"), f"array({_pair('user', 'prompt')}, {_pair('assistant', 'completion')})"),
    Layout(
        "instruction",
        ("instruction", "input", "output"),
        f"""array({_pair('user', "concat_ws('\\n\\n', instruction, nullif(input, ''))")}, {_pair('assistant', 'output')})""",
    ),
    Layout("instruction_only", ("instruction", "output"), f"array({_pair('user', 'instruction')}, {_pair('assistant', 'output')})"),
    Layout(
        "system_prompt",
        ("system", "prompt", "response"),
        f"array({_pair('system', 'system')}, {_pair('user', 'prompt')}, {_pair('assistant', 'response')})",
    ),
)


def select_layout(schema: T.StructType, id_column: str = "conv_id", layouts=LAYOUTS) -> Layout:
    """The layout whose fingerprint equals that of the schema's paths which layouts know of.

    Columns that no layout names are ignored. Where other columns make more than one layout fit, the one
    with most paths wins. No fitting layout is an error.
    """
    paths = {path for path in field_paths(schema) if path != id_column}
    known = {layout.key: layout for layout in layouts}
    exact = known.get(fingerprint(paths & {path for layout in layouts for path in layout.paths}))
    if exact:
        return exact
    fitting = [layout for layout in layouts if known.get(fingerprint(paths & set(layout.paths))) is layout]
    if not fitting:
        raise ValueError(f"no declared layout has the field paths {sorted(paths)}")
    return max(fitting, key=lambda layout: len(layout.paths))


def canonical_turns(df: DataFrame, id_column: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """conv_id, turn, role and text from a frame in any declared layout. Nulls in lists give no turn."""
    layout = select_layout(df.schema, id_column, layouts)
    if layout.turns is None:
        return df.select(F.col(id_column).alias("conv_id"), "turn", "role", "text")
    turns = df.select(F.col(id_column).alias("conv_id"), F.posexplode(F.expr(layout.turns)).alias("turn", "_turn"))
    return turns.where(F.col("_turn").isNotNull()).select("conv_id", F.col("turn").cast("long").alias("turn"), "_turn.role", "_turn.text")


def canonical_json(df: DataFrame, json_column: str, id_column: str = "conv_id", layouts=LAYOUTS) -> DataFrame:
    """The same for JSON texts whose layout differs from row to row, chosen by each row's own fingerprint.

    Of a row's paths those count that some layout names, over all elements of its lists, as ``select_layout`` does with columns: further
    keys and null messages do not matter. Rows that are no JSON object, or of a layout nobody declared, give no turns;
    ``json_layouts`` counts them.
    """
    read = F.col("_row")
    parts = []
    for layout in layouts:
        if layout.turns is None:
            continue
        fields: dict[str, set[str]] = {}
        for path in layout.paths:
            top, _, leaf = path.partition("[].")
            fields.setdefault(top, set()).add(leaf)
        ddl = ", ".join(f"`{top}` " + (f"array<struct<{', '.join(f'`{x}`: string' for x in sorted(leaves))}>>" if leaves != {""} else "string") for top, leaves in fields.items())
        sub = df.select(F.col(id_column).alias("_id"), F.col(json_column).alias("_json")).where(_json_layout(F.col("_json"), layouts) == layout.name)
        sub = sub.select("_id", F.from_json("_json", ddl).alias("_row")).where(read.isNotNull()).select("_id", "_row.*")
        parts.append(canonical_turns(sub.withColumnRenamed("_id", "conv_id"), "conv_id", (layout,)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def json_layouts(df: DataFrame, json_column: str, layouts=LAYOUTS) -> DataFrame:
    """Rows per layout; null for rows of no declared layout."""
    return df.groupBy(_json_layout(F.col(json_column), layouts).alias("layout")).count()


def _json_layout(json: Column, layouts) -> Column:
    """Name of the layout whose fingerprint a JSON text has, else of the fitting one with most paths, else null."""
    layouts = [layout for layout in layouts if layout.turns is not None]
    lists = sorted({path.partition("[].")[0] for layout in layouts for path in layout.paths if "[]." in path})
    known = sorted({path for layout in layouts for path in layout.paths})
    tops = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))

    def inside(top: str) -> Column:
        elements = F.from_json(F.get_json_object(json, f"$.{top}"), "array<map<string,string>>")
        keys = F.flatten(F.transform(F.filter(elements, lambda x: x.isNotNull()), F.map_keys))
        paths = F.transform(keys, lambda key: F.concat(F.lit(f"{top}[]."), key))
        return F.coalesce(paths, F.array().cast("array<string>"))

    found = [tops, *map(inside, lists)]
    present = F.array_intersect(F.array(*map(F.lit, known)), F.concat(*found))  # in the order of ``known``
    names = F.create_map(*[F.lit(x) for layout in layouts for x in (layout.key, layout.name)])
    exact = F.try_element_at(names, F.sha2(F.array_join(present, "\n"), 256))
    # sorting is stable: of layouts with as many paths the first declared one
    fitting = [
        F.when(F.size(F.array_intersect(present, F.array(*map(F.lit, layout.paths)))) == len(layout.paths), layout.name)
        for layout in sorted(layouts, key=lambda layout: -len(layout.paths))
    ]
    return F.coalesce(exact, *fitting)


def escape(text: Column, marks: str = r"\\#<") -> Column:
    return F.regexp_replace(text, f"([{marks}])", r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: its formatted text and the place of its loss span in it, in code points.

    Formatted texts of a conversation, joined in order of turn, are the training text. Only assistant
    texts are under the loss. A null role or text is empty. Turns of equal number follow each other by
    role and text; rows of a null conversation are one conversation. An empty table gives no rows; other columns play no
    part and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, r"\\#<:"), F.lit(BETWEEN))
    body = escape(text)
    loss = role == "assistant"
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.when(loss, F.char_length(head)).otherwise(0).alias("loss_start"),
        F.when(loss, F.char_length(body)).otherwise(0).alias("loss_length"),
    )


_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"not a turn at {at}")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


ship(__name__)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: turns, their digest, and what lies under the loss mask, parsed from the output.

    A digest needs the turns in order, so a conversation is read by one task, but as a stream of sorted
    rows: memory stays within a batch however long it is. An empty table gives no rows; other columns play no part.
    """

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = object(), None

        def done(conv, s):
            return {
                "conv_id": conv, "n_turns": s[0], "turns_sha256": s[1].hexdigest(), "loss_chars": s[2],
                "loss_sha256": s[3].hexdigest(), "formatted_chars": s[4],
            }

        for batch in batches:
            rows = []
            for conv, text, start, length in zip(batch["conv_id"], batch["formatted"], batch["loss_start"], batch["loss_length"]):
                conv = None if pd.isna(conv) else int(conv)
                if state is None or conv != current:
                    if state is not None:
                        rows.append(done(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                loss = unescape(text[start : start + length])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
            yield pd.DataFrame(rows, columns=NAMES).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([done(current, state)], columns=NAMES).astype({"conv_id": "Int64"})

    NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    return ordered.select("conv_id", "formatted", "loss_start", "loss_length").mapInPandas(digests, schema)


def control_conversation(spark) -> DataFrame:
    """Conversation -7, whose texts are made of control strings."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], CANONICAL)
