r"""Chat formatting: heterogeneous records to canonical turns to one template.

Records are JSON texts, or structs with null for an absent field, of any known
layout: prompt and response, instruction with input, lists of messages.  The layout of a record is told by its schema
fingerprint, a hash of its sorted nested field paths; the fingerprint selects
a declarative mapping (an SQL expression) that yields canonical turns
(role, text).  The template writes a turn as

    <|im_start|>role newline text <|im_end|> newline

as segments (text, loss); the loss mask covers the texts of the assistant's
turns and nothing else.  Control strings inside texts are escaped: ``<``, any
number of ``%``, ``|`` gains one ``%``, so no text can open or close a turn;
``unescaped`` takes it back.  In a role, ``\`` and newline are escaped too.

Defined cases: a null text or role is empty; a null or unparsable record, and
one whose fingerprint no mapping has, gives null turns and a null layout; an
unparsable JSON text of over ``JSON_CHARS`` characters raises, since Spark's
JSON functions give null for valid longer strings too (structs, and so the
query, have no such bound); an
empty list of turns gives an empty output; rows of one conversation
are ordered by turn, role and text, nulls first, repeated rows each count; a
null conv_id is a conversation of its own; columns of other names are ignored
by ``conversation_records``.

Only DataFrame functions are used: no Python runs on an executor.  A
conversation is one output string, so its turns meet in one row by nature;
nothing larger than a conversation does.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
JSON_CHARS = 20_000_000     # the longest string that Spark's JSON parser takes
TURNS = "array<struct<role:string,text:string>>"
NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


# ---- schema fingerprints and mappings

def field_paths(record: Column) -> Column:
    """The sorted nested field paths of a JSON text, array levels marked [], as one string."""
    parsed = F.try_parse_json(record)
    shape = F.when(parsed.isNull() & (F.length(record) > JSON_CHARS), F.raise_error(
        F.lit("a JSON record is too long to be parsed; pass it as a struct")).cast("string")).otherwise(F.schema_of_variant(parsed))
    # the variant's schema lists the fields in order; what is left without the types are the paths
    shape = F.regexp_replace(shape, r"\b(STRING|VOID|BIGINT|DOUBLE|BOOLEAN|DECIMAL\(\d+,\s?\d+\)|VARIANT)\b", "")
    return F.regexp_replace(F.regexp_replace(shape, r"\s+", ""), "OBJECT|ARRAY", "")


def struct_paths(record: Column, kind: T.StructType) -> Column:
    """``field_paths`` of a struct, in which a null field is absent."""
    def inner(value: Column, of: T.DataType) -> Column:
        if isinstance(of, T.StructType):
            return struct_paths(value, of)
        if isinstance(of, T.ArrayType):
            return F.when(F.size(value) == 0, "<>").otherwise(F.lit(f"<{element_paths(of.elementType)}>"))
        return F.lit("")

    def element_paths(of: T.DataType) -> str:
        if isinstance(of, T.ArrayType):
            return f"<{element_paths(of.elementType)}>"
        if isinstance(of, T.StructType):
            return "<" + ",".join(f"{f.name}:{element_paths(f.dataType)}" for f in sorted(of, key=lambda f: f.name)) + ">"
        return ""

    fields = [F.when(record[f.name].isNotNull(), F.concat(F.lit(f"{f.name}:"), inner(record[f.name], f.dataType)))
              for f in sorted(kind, key=lambda f: f.name)]
    return F.concat(F.lit("<"), F.concat_ws(",", *fields), F.lit(">"))


def fingerprint(record: Column, kind: T.DataType | None = None) -> Column:
    return F.xxhash64(struct_paths(record, kind) if isinstance(kind, T.StructType) else field_paths(record))


def _turn(role: str, path: str) -> str:
    return f"named_struct('role', '{role}', 'text', coalesce(get_json_object(record, '$.{path}'), ''))"


def _messages(name: str, role: str, text: str) -> str:
    items = f"from_json(record, 'STRUCT<`{name}`: ARRAY<STRUCT<`{role}`: STRING, `{text}`: STRING>>>').`{name}`"
    return (f"transform({items}, x -> named_struct('role', coalesce(x.`{role}`, ''), "
            f"'text', coalesce(x.`{text}`, '')))")


#: An example of each layout and the expression over ``record`` that yields its turns.
LAYOUTS: Mapping[str, tuple[str, str]] = {
    "prompt": ('{"prompt": "a", "response": "b"}', f"array({_turn('user', 'prompt')}, {_turn('assistant', 'response')})"),
    "system prompt": ('{"prompt": "a", "response": "b", "system": "c"}',
                      f"array({_turn('system', 'system')}, {_turn('user', 'prompt')}, {_turn('assistant', 'response')})"),
    "instruction": ('{"instruction": "a", "output": "b"}',
                    f"array({_turn('user', 'instruction')}, {_turn('assistant', 'output')})"),
    "instruction with input": (
        '{"input": "b", "instruction": "a", "output": "c"}',
        "array(named_struct('role', 'user', 'text', concat_ws('\\n', get_json_object(record, '$.instruction'), "
        f"nullif(get_json_object(record, '$.input'), ''))), {_turn('assistant', 'output')})"),
    "messages": ('{"messages": [{"content": "a", "role": "b"}]}', _messages("messages", "role", "content")),
    "conversations": ('{"conversations": [{"from": "a", "value": "b"}]}', _messages("conversations", "from", "value")),
    "dialog": ('{"data": {"turns": [{"speaker": "a", "text": "b"}]}}',
               _messages("turns", "speaker", "text").replace("from_json(record,", "from_json(get_json_object(record, '$.data'),")),
    "no turns": ('{"messages": []}', f"cast(array() as {TURNS})"),
}


#: The mappings of the layouts that also come as structs.
FIELDS: Mapping[str, str] = {
    "prompt": ("array(named_struct('role', 'user', 'text', record.prompt), "
               "named_struct('role', 'assistant', 'text', record.response))"),
    "instruction": ("array(named_struct('role', 'user', 'text', record.instruction), "
                    "named_struct('role', 'assistant', 'text', record.output))"),
    "instruction with input": (
        "array(named_struct('role', 'user', 'text', concat_ws('\\n', record.instruction, nullif(record.input, ''))), "
        "named_struct('role', 'assistant', 'text', record.output))"),
    "system prompt": ("array(named_struct('role', 'system', 'text', record.system), "
                      "named_struct('role', 'user', 'text', record.prompt), "
                      "named_struct('role', 'assistant', 'text', record.response))"),
    "messages": ("transform(record.messages, x -> named_struct('role', coalesce(x.role, ''), "
                 "'text', coalesce(x.content, '')))"),
    "no turns": f"cast(array() as {TURNS})",
}


def with_turns(records: DataFrame, layouts: Mapping[str, tuple[str, str]] = LAYOUTS, rename: bool | None = None) -> DataFrame:
    """``records`` (record, ...) with ``layout`` and canonical ``turns``, both null where no mapping fits.

    With ``rename`` the other names of the usual roles become user and
    assistant; by default so for JSON texts, while the turns of structs keep the
    roles that they were given.
    """
    spark = records.sparkSession
    # the fingerprints of the few known layouts, made from their examples
    prints = spark.range(1).select(*[fingerprint(F.lit(example)).alias(k) for k, (example, _) in layouts.items()]).first()
    mark, layout, turns = F.col("schema_print"), F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    kind = records.schema["record"].dataType
    if isinstance(kind, T.StructType):
        layouts = {k: (example, FIELDS[k]) for k, (example, _) in layouts.items()
                   if k in FIELDS and set(json.loads(example)) <= set(kind.names)}
    for name, (_, expression) in layouts.items():
        layout = F.when(mark == prints[name], name).otherwise(layout)
        turns = F.when(mark == prints[name], F.expr(expression).cast(TURNS)).otherwise(turns)
    out = records.withColumn("schema_print", fingerprint(F.col("record"), kind))
    if rename is None:
        rename = not isinstance(kind, T.StructType)
    return out.withColumn("layout", layout).withColumn("turns", canonical(turns) if rename else turns).drop("schema_print")


def canonical(turns: Column) -> Column:
    """Other names of the three usual roles become user, assistant, system; the rest stay."""
    def role(x: Column) -> Column:
        out = x["role"]
        for name, to in NAMES.items():
            out = F.when(x["role"] == name, to).otherwise(out)
        return out
    return F.transform(turns, lambda x: F.struct(role(x).alias("role"), x["text"].alias("text")))


# ---- template

def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(%*)\|", "<%$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<%(%*)\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def segments(turns: Column) -> Column:
    """Template segments (text, loss) of canonical turns; the output is their concatenation."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return F.flatten(F.transform(turns, lambda x: F.array(
        piece(F.concat(F.lit(START), escaped_role(x["role"]), F.lit("\n")), F.lit(False)),
        piece(escaped(x["text"]), x["role"] == "assistant"),
        piece(F.lit(f"{END}\n"), F.lit(False)))))


def formatted(rows: DataFrame) -> DataFrame:
    """``rows`` (turns, ...) with ``segments`` and ``formatted`` in place of ``turns``."""
    return (rows.withColumn("segments", segments(F.col("turns"))).drop("turns")
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_back(output: Column) -> Column:
    """Canonical turns out of a formatted string."""
    # no text holds the opening string, so what precedes the first one is empty
    turns = F.filter(F.split(output, r"<\|im_start\|>"), lambda t: t != "")
    text = lambda t: F.substr(t, F.locate("\n", t) + 1, F.length(t) - F.locate("\n", t) - len(END) - 1)
    return F.transform(turns, lambda t: F.struct(unescaped_role(F.substring_index(t, "\n", 1)).alias("role"),
                                                 unescaped(text(t)).alias("text")))


# ---- the query's records

def conversation_records(rows: DataFrame) -> DataFrame:
    """One record (conv_id, record) per conversation of the turn table, in the layout its turns fit.

    A user and an assistant turn: prompt and response, or, where the user's
    text goes on behind its first line, instruction, input and output; a system
    turn before them: with system; else a list of messages.  A record is a
    struct, so no text passes through Spark's JSON parser and its bound on a
    string.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: F.replace(x["role"], F.lit(" "), F.lit("_"))), " ")
    at = lambda i: F.get("t", F.lit(i))["text"]
    messages = F.transform("t", lambda x: F.struct(x["text"].alias("content"), x["role"].alias("role")))
    pair, three = roles == "user assistant", roles == "system user assistant"
    line = F.locate("\n", at(0))       # where the first line ends, 0 if it is the only one
    lines = pair & (line > 0) & (line < F.length(at(0)))
    two = pair & ~lines
    record = F.struct(F.when(two, at(0)).when(three, at(1)).alias("prompt"),
                      F.when(two, at(1)).when(three, at(2)).alias("response"),
                      F.when(three, at(0)).alias("system"),
                      F.when(lines, F.substr(at(0), F.lit(1), line - 1)).alias("instruction"),
                      F.when(lines, F.substr(at(0), line + 1)).alias("input"),
                      F.when(lines, at(1)).alias("output"),
                      F.when(~(pair | three), messages).alias("messages"))
    return convs.select("conv_id", record.alias("record"))


def digest(rows: DataFrame) -> DataFrame:
    """The contract's columns, read back from ``formatted`` and ``segments``."""
    back = rows.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                       unescaped(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                                          lambda s: s["text"]), "")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(role, '\', '\\')) + length(regexp_replace(text, '<(%*)\|', '<%\1|', 'g')) + 12 + 1 + 10 + 1)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
