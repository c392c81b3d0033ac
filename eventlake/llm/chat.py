"""Chat formatting: heterogeneous records to canonical turns to one template.

A record is JSON of any layout. The nested field paths of its parsed form are hashed,
and the hash picks a declarative mapping that turns the record into (role, text) turns.
The template marks turns; inside roles and texts every ``<`` and ``[`` is followed by a
backslash, so no control string of this or another common template survives there, and
dropping that backslash gives the text back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import scan_array

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TURNS = "array<struct<role:string,text:string>>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns. ``paths`` is the sorted nested structure of its
    records with scalars as ``*``. Either ``fields`` lists (role, field) in order, or
    ``items`` names an array whose objects hold role and text; ``roles`` renames roles."""

    name: str
    paths: str
    fields: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)

    def turns(self, record: Column) -> Column:
        if self.items is None:
            return F.array(
                *[
                    F.struct(F.lit(role).alias("role"), F.try_variant_get(record, f"$.{name}", "string").alias("text"))
                    for role, name in self.fields
                ]
            )
        name, role, text = self.items
        listed = F.try_variant_get(record, f"$.{name}", f"array<struct<{role}:string,{text}:string>>")

        def turn(x):
            renamed = x[role]
            for before, after in self.roles.items():
                renamed = F.when(x[role] == before, F.lit(after)).otherwise(renamed)
            return F.struct(renamed.alias("role"), x[text].alias("text"))

        return F.transform(listed, turn)


LAYOUTS = (
    Layout("prompt", "OBJECT<completion: *, prompt: *>", (("user", "prompt"), (ASSISTANT, "completion"))),
    Layout("instruction", "OBJECT<instruction: *, output: *>", (("user", "instruction"), (ASSISTANT, "output"))),
    Layout(
        "instruction_system", "OBJECT<input: *, instruction: *, output: *>",
        (("system", "instruction"), ("user", "input"), (ASSISTANT, "output")),
    ),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content: *, role: *>>>", items=("messages", "role", "content")),
    Layout(
        "conversations", "OBJECT<conversations: ARRAY<OBJECT<from: *, value: *>>>",
        items=("conversations", "from", "value"), roles={"human": "user", "gpt": ASSISTANT},
    ),
)


def paths(record: Column) -> Column:
    """Nested structure of a variant: its sorted field paths, with scalars as ``*``."""
    return F.regexp_replace(F.schema_of_variant(record), r"\b[A-Z]+(\(\d+,\s*\d+\))?(?=[,>]|$)", "*")


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``layout`` and ``turns`` for the JSON in ``record``.

    A record that is no JSON, or whose paths no layout has, keeps null turns and the
    layout ``unknown``; it is not dropped. Null texts become empty.
    """
    rows = records.withColumn("variant_", F.try_parse_json(F.col("record")))
    rows = rows.withColumn("print_", F.xxhash64(paths(F.col("variant_"))))
    name, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for layout in layouts:
        known = F.col("print_") == F.xxhash64(F.lit(layout.paths))
        name = F.when(known, layout.name).otherwise(name)
        turns = F.when(known, layout.turns(F.col("variant_"))).otherwise(turns)
    filled = F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")
        ),
    )
    return rows.select(*records.columns, name.alias("layout"), filled.alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<")), F.lit("[\\"), F.lit("["))


def formatted(canonical_rows: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``loss``, the spans (start, end) of assistant texts in it,
    in code points."""
    rows = canonical_rows.withColumn(
        "parts_",
        F.transform(
            "turns",
            lambda t: F.struct(
                (t["role"] == ASSISTANT).alias("learn"),
                F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ),
    )
    span = "struct<start:int,end:int>"

    def step(at, p):
        start = at + F.char_length(p["head"])
        end = start + F.char_length(p["body"])
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(END)).alias("state"),
            F.when(p["learn"], own).otherwise(F.array().cast(f"array<{span}>")).alias("outs"),
        )

    text = F.array_join(F.transform("parts_", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return rows.withColumns(
        {"formatted": text, "loss": scan_array(F.col("parts_"), F.lit(0), step, span)}
    ).drop("parts_")


def read_back(text: Column) -> Column:
    """The turns in a formatted text."""
    quoted = {m: "\\Q" + m + "\\E" for m in (TURN, TEXT, END)}
    # What follows the last end mark is empty.
    parts = F.filter(F.split(text, quoted[END], -1), lambda p: p != "")

    def turn(part):
        role = F.substring_index(part, TEXT, 1)
        return F.struct(
            unescape(F.replace(role, F.lit(TURN), F.lit(""))).alias("role"),
            unescape(F.replace(F.element_at(F.split(part, quoted[TEXT], -1), 2), F.lit(TEXT), F.lit(""))).alias("text"),
        )

    return F.transform(parts, turn)


def under_mask(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    wide = F.encode(text, "UTF-32")  # four bytes each, so a span is found without a walk
    return F.array_join(
        F.transform(
            loss,
            lambda s: unescape(
                F.decode(F.substring(wide, 4 * s["start"] + 1, 4 * (s["end"] - s["start"])), "UTF-32")
            ),
        ),
        "",
    )


def records(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): each conversation as JSON in a layout that fits its roles.

    Turns are ordered by turn, then role and text. A conversation is one training
    example, so its turns come together in one row, whatever their number.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    whole = whole.withColumn("roles_", F.transform("t", lambda x: x["role"]))
    said = [F.col("t")[i]["text"] if i == 0 else F.get("t", F.lit(i))["text"] for i in range(3)]
    usual = F.forall("roles_", lambda r: r.isin("system", "user", ASSISTANT))
    shared_from = F.transform(
        "t",
        lambda x: F.struct(
            F.when(x["role"] == "user", "human").when(x["role"] == ASSISTANT, "gpt").otherwise(x["role"]).alias("from"),
            x["text"].alias("value"),
        ),
    )
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    same = lambda *roles: F.col("roles_") == F.array(*[F.lit(r) for r in roles])
    record = (
        F.when(same("user", ASSISTANT), F.to_json(F.struct(said[0].alias("prompt"), said[1].alias("completion"))))
        .when(
            same("system", "user", ASSISTANT),
            F.to_json(F.struct(said[0].alias("instruction"), said[1].alias("input"), said[2].alias("output"))),
        )
        .when(usual, F.to_json(F.struct(shared_from.alias("conversations"))))
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return whole.select("conv_id", record.alias("record"))


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted text: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, layout.

    Null texts and roles are empty; a null turn comes first; ties are ordered by role and
    text; repeated rows are turns of their own; rows with a null conv_id are one
    conversation. An empty table gives no rows. Further columns are not looked at.
    """
    rows = formatted(canonical(records(conversations)))
    rows = rows.select(
        "conv_id", "layout", "formatted",
        read_back(F.col("formatted")).alias("turns"),
        under_mask(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )
