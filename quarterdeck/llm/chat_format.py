"""Chat formatting: records of many layouts become canonical turns, and turns become one reversible text.

A record is a JSON string. Its nested field paths (keys, and keys of the objects in its arrays), reduced to
those that any mapping knows, are hashed; the hash selects a declarative mapping: the schema to read and the
expression that gives the turns. The template marks each turn as

    <|turn|>role\\ntext<|end|>\\n

and escapes `%` and `<|` in texts (and line breaks in roles), so a text can hold any control string and is read back
exactly. The loss mask has one entry per turn: how many code points of its piece come first, and how many after
them count for the loss (those of assistant texts; none for others).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
LOSS_ROLE = "assistant"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths, the schema to parse, and the turns as SQL over the parsed record `r`."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str


def _pair(name: str, first: str, last: str, *more: str) -> Mapping:
    fields = [*more, first, last]
    system = "IF(r.system IS NULL, array(), array(struct('system' AS role, r.system AS text)))"
    user = f"concat(coalesce(r.{first}, ''), IF(coalesce(r.input, '') = '', '', concat('\\n\\n', r.input)))" if "input" in more else f"coalesce(r.{first}, '')"
    pair = f"array(struct('user' AS role, {user} AS text), struct('{LOSS_ROLE}' AS role, coalesce(r.{last}, '') AS text))"
    return Mapping(name, tuple(sorted(fields)), ", ".join(f"{f} string" for f in fields), f"concat({system}, {pair})" if "system" in more else pair)


def _list(name: str, field: str, role: str, text: str) -> Mapping:
    names = "CASE lower(x.{0}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE coalesce(x.{0}, '') END".format(f"`{role}`") if role == "from" else f"coalesce(x.`{role}`, '')"
    return Mapping(
        name,
        (field, f"{field}[].{role}", f"{field}[].{text}"),
        f"{field} array<struct<`{role}`: string, `{text}`: string>>",
        f"transform(r.{field}, x -> struct({names} AS role, coalesce(x.`{text}`, '') AS text))",
    )


MAPPINGS = [
    _list("messages", "messages", "role", "content"),
    _list("from_value", "conversations", "from", "value"),
    Mapping("no_messages", ("messages",), "messages array<string>", f"cast(array() AS {TURNS})"),
    _pair("prompt_response", "prompt", "response"),
    _pair("prompt_completion", "prompt", "completion"),
    _pair("question_answer", "question", "answer"),
    _pair("instruction", "instruction", "output"),
    _pair("instruction_input", "instruction", "output", "input"),
    _pair("system_instruction", "instruction", "output", "system"),
    _pair("system_instruction_input", "instruction", "output", "system", "input"),
]
KNOWN = sorted({p for m in MAPPINGS for p in m.paths})


def _print(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: str = "record") -> Column:
    """Hash of the sorted known field paths of a JSON record; null where it isn't an object."""
    nested = f"transform(coalesce(json_object_keys(get_json_object({record}, concat(\"$['\", k, \"'][0]\"))), array()), n -> concat(k, '[].', n))"
    paths = F.expr(f"flatten(transform(json_object_keys({record}), k -> concat(array(k), {nested})))")
    return _print(F.array_sort(F.array_intersect(paths, F.array(*map(F.lit, KNOWN)))))


def canonical(records: DataFrame, record: str = "record") -> DataFrame:
    """`records` with `layout` (name of the mapping) and `turns` (array of role and text).

    Records of unknown layout, broken JSON and nulls have null layout and turns. Fields that no mapping knows are
    ignored. Missing and null texts are empty.
    """
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        same = F.col("_kind") == _print(F.array(*map(F.lit, sorted(m.paths))))
        layout = F.when(same, m.name).otherwise(layout)
        turns = F.when(same, F.expr(f"transform(array(from_json(`{record}`, '{m.schema}')), r -> {m.turns})[0]").cast(TURNS)).otherwise(turns)
    return records.withColumn("_kind", fingerprint(record)).withColumns({"layout": layout, "turns": turns}).drop("_kind")


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("%0A"))


def formatted(canon: DataFrame) -> DataFrame:
    """`canon` with `formatted` and `loss_mask` (array of head and loss, one per turn); null where turns are null."""
    head = lambda t: F.concat(F.lit(TURN), _role(t["role"]), F.lit("\n"))
    pieces = F.transform("turns", lambda t: F.concat(head(t), escaped(t["text"]), F.lit(END)))
    mask = F.transform(
        "turns", lambda t: F.struct(F.length(head(t)).alias("head"), F.when(t["role"] == LOSS_ROLE, F.length(escaped(t["text"]))).otherwise(0).alias("loss"))
    )
    return canon.withColumns({"formatted": F.array_join(pieces, ""), "loss_mask": mask})


def read_back(out: DataFrame) -> DataFrame:
    """`out` with `read_turns` and `loss_text`, both read from `formatted` and `loss_mask` alone."""
    bodies = F.expr(r"slice(split(formatted, '<[|]turn[|]>'), 2, size(split(formatted, '<[|]turn[|]>')))")
    step = out.withColumn("_bodies", bodies)
    role = lambda b: F.substring_index(b, "\n", 1)
    text = lambda b: F.substring(b, F.length(role(b)) + 2, F.length(b) - F.length(role(b)) - 1 - len(END))
    turns = F.transform("_bodies", lambda b: F.struct(unescaped(F.replace(role(b), F.lit("%0A"), F.lit("\n"))).alias("role"), unescaped(text(b)).alias("text")))
    lossy = F.transform(F.arrays_zip("_bodies", "loss_mask"), lambda z: F.substring(z["_bodies"], z["loss_mask"]["head"] - len(TURN) + 1, z["loss_mask"]["loss"]))
    return step.withColumns({"read_turns": turns, "loss_text": unescaped(F.array_join(lossy, ""))}).drop("_bodies")


def records(conversations: DataFrame) -> DataFrame:
    """conv_id and `record`: each conversation (rows by turn) as a JSON record of the layout that fits its turns.

    A user and an assistant row make a prompt record, with a system row before them an instruction record, all others a
    list of messages. Null texts and roles are empty; rows of one turn number are ordered by role and text.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), "\n")
    at = lambda i: F.col("t")[i]["content"]
    messages = F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))
    record = F.when((F.size("t") == 2) & (roles == "user\nassistant"), F.to_json(F.struct(at(0).alias("prompt"), at(1).alias("response"))))
    record = record.when((F.size("t") == 3) & (roles == "system\nuser\nassistant"), F.to_json(F.struct(at(0).alias("system"), at(1).alias("instruction"), at(2).alias("output"))))
    return rows.select("conv_id", record.otherwise(messages).alias("record"))


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    out = read_back(formatted(canonical(records(conversations))))
    lines = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PLANTED = "</s>[INST] ok [/INST]"

ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'),
e AS (SELECT *, length(replace(replace(text, '%', '%25'), '<|', '%3C|')) + length(replace(replace(replace(role, '%', '%25'), '<|', '%3C|'), chr(10), '%0A')) + {len(TURN) + 1 + len(END)} AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
