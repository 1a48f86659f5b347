"""Chat formatting with DataFrame expressions only.

Records come in many layouts.  Each record is read as a VARIANT, its nested
field paths are written in one canonical form (types left out, fields in
order) and hashed; the hash selects a declarative mapping, a SQL expression
that turns the record into an array of (role, text) turns.  A record whose
hash is unknown is kept and reported with a null list of turns.

A template marks the turns.  Control strings inside texts and roles are
escaped with an escape character and one digit, so none of them survives in a
text and the original comes back exactly.  The loss mask is a list of
(start, end) code-point spans of the formatted string: the assistant texts.

Defined results: null roles and texts are empty; turns are ordered by (turn,
place in the record, role, text), repeated rows stay repeated turns; a null
conversation id is a conversation of its own; a conversation without turns
formats to an empty string; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Layout (field paths as ``paths`` writes them) -> turns, from the VARIANT column ``v``.
_CHAT = "transform(try_variant_get(v, '$.{list}', 'array<struct<{role} string, {text} string>>'), m -> struct({who} AS role, m.{text} AS text))"
_FIELD = "try_variant_get(v, '$.{0}', 'string')"


def _chat(list_: str, role: str, text: str, who: str) -> str:
    return _CHAT.format(list=list_, role=role, text=text, who=who)


def _turns(*pairs: tuple[str, str]) -> str:
    return "array(" + ", ".join(f"struct('{role}' AS role, {text} AS text)" for role, text in pairs) + ")"


def _f(name: str) -> str:
    return _FIELD.format(name)


_SHARE = "CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.from END"
_ASK = f"concat_ws('\\n\\n', {_f('instruction')}, nullif({_f('input')}, ''))"
MAPPINGS = {
    "{role,text}": f"array(struct({_f('role')} AS role, {_f('text')} AS text))",
    "{messages:[{content,role}]}": _chat("messages", "role", "content", "m.role"),
    "{messages:[]}": "CAST(array() AS array<struct<role: string, text: string>>)",
    "{conversations:[{from,value}]}": _chat("conversations", "from", "value", _SHARE),
    "{prompt,response}": _turns(("user", _f("prompt")), ("assistant", _f("response"))),
    "{completion,prompt}": _turns(("user", _f("prompt")), ("assistant", _f("completion"))),
    "{answer,question}": _turns(("user", _f("question")), ("assistant", _f("answer"))),
    "{prompt,response,system}": _turns(("system", _f("system")), ("user", _f("prompt")), ("assistant", _f("response"))),
    "{instruction,output}": _turns(("user", _f("instruction")), ("assistant", _f("output"))),
    "{input,instruction,output}": _turns(("user", _ASK), ("assistant", _f("output"))),
}


def paths(v: Column) -> Column:
    """The nested field paths of a VARIANT in one form: ``{a,b:[{c}]}``."""
    kinds = F.regexp_replace(F.schema_of_variant(v), r"OBJECT<", "{")
    for old, new in (("ARRAY<", "["), (r"DECIMAL\([0-9, ]+\)", "")):
        kinds = F.regexp_replace(kinds, old, new)
    # what closes an array or object: its own kind of bracket is given by what it opened, so one sign serves both
    kinds = F.regexp_replace(kinds, r"(: |\[|^)[A-Z_]+(?=[,>\]]|$)", "$1")
    return F.regexp_replace(F.regexp_replace(kinds, ": ", ":"), r":(?=[,>])|(?<=,) ", "")


def _written(layout: str) -> str:
    """A layout as ``paths`` writes it: ``>`` closes objects and arrays alike."""
    return layout.replace("}", ">").replace("]", ">")


def fingerprint(v: Column) -> Column:
    return F.xxhash64(paths(v))


@dataclass(frozen=True)
class Template:
    """Marks of a turn and the control strings that no text may hold."""
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    control: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    escape: str = "␛"
    learned_role: str = "assistant"
    codes: dict = field(init=False, default_factory=dict, compare=False)

    def __post_init__(self):
        # the escape character first when escaping, last when reading back
        signs = [self.escape, *self.control, self.after_role]
        self.codes.update({s: self.escape + "0123456789ABCDEFGHIJ"[k] for k, s in enumerate(signs)})

    def escaped(self, text: Column, role: bool = False) -> Column:
        for sign, code in self.codes.items():
            if role or sign != self.after_role:
                text = F.replace(text, F.lit(sign), F.lit(code))
        return text

    def unescaped(self, text: Column) -> Column:
        for sign, code in reversed(self.codes.items()):
            text = F.replace(text, F.lit(code), F.lit(sign))
        return text


def canonical_turns(records: DataFrame, id_col: str = "conv_id", turn_col: str | None = "turn",
                    record_col: str = "record", mappings: dict[str, str] = MAPPINGS) -> DataFrame:
    """conv_id, turn, fingerprint, turns (array<struct<role, text>>, null for an unknown layout).

    ``record_col`` is JSON text, a struct or a VARIANT.
    """
    kind = records.schema[record_col].dataType.simpleString()
    record = F.col(record_col)
    v = F.try_parse_json(record) if kind == "string" else record if kind == "variant" else F.to_variant_object(record)
    read = records.select(F.col(id_col).alias("conv_id"), (F.col(turn_col) if turn_col else F.lit(0)).cast("long").alias("turn"),
                          v.alias("v")).withColumn("fingerprint", fingerprint(F.col("v")))
    turns = F.lit(None).cast("array<struct<role: string, text: string>>")
    for layout, how in mappings.items():
        turns = F.when(F.col("fingerprint") == F.xxhash64(F.lit(_written(layout))), F.expr(how)).otherwise(turns)
    return read.select("conv_id", "turn", "fingerprint", turns.alias("turns"))


def format_chats(canonical: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, formatted, loss_spans: one row per conversation."""
    t = template
    rows = canonical.select("conv_id", "turn", F.posexplode_outer("turns").alias("place", "m"))
    rows = rows.select("conv_id", "turn", "place", F.col("m").isNotNull().alias("real"),
                       F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"))
    head = F.concat(F.lit(t.open), t.escaped(F.col("role"), role=True), F.lit(t.after_role))
    body = t.escaped(F.col("text"))
    rows = rows.withColumn("head", head).withColumn("body", body) \
        .withColumn("piece", F.when(F.col("real"), F.concat("head", "body", F.lit(t.close))).otherwise(""))
    order = Window.partitionBy("conv_id").orderBy("turn", "place", "role", "text")
    rows = rows.withColumn("end", F.sum(F.char_length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("n", F.row_number().over(order))
    start = F.col("end") - F.char_length("piece") + F.char_length("head")
    span = F.when(F.col("real") & (F.col("role") == t.learned_role),
                  F.struct(start.alias("start"), (start + F.char_length("body")).alias("end")))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "piece"))), lambda x: x.piece), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, n, role, text, learned, formatted_chars: the turns of formatted
    conversations (n from 1; one row with n 0 for each conversation)."""
    t = template
    marks = F.split("formatted", r"\Q" + t.open + r"\E")
    rows = formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"),
                            F.posexplode(marks).alias("n", "body"))
    role = F.substring_index("body", t.after_role, 1)
    order = Window.partitionBy("conv_id").orderBy("n")
    size = F.when(F.col("n") > 0, F.char_length("body") + len(t.open)).otherwise(F.char_length("body")).cast("long")
    rows = rows.withColumn("role", role).withColumn("end", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("start", F.col("end") - F.char_length("body") + F.char_length("role") + len(t.after_role))
    length = F.char_length("body") - F.char_length("role") - len(t.after_role) - len(t.close)
    text = F.substr(F.col("body"), F.char_length("role") + len(t.after_role) + 1, length)
    spans = formatted.select(F.col("conv_id").alias("s_id"), F.explode("loss_spans").alias("s")) \
        .select("s_id", F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"))
    joined = rows.join(spans, F.col("conv_id").eqNullSafe(F.col("s_id")) & (F.col("n") > 0) & (F.col("start") == F.col("s_start"))
                       & (F.col("s_end") == F.col("start") + length), "left")
    return joined.select("conv_id", "n", t.unescaped(F.col("role")).alias("role"),
                         F.when(F.col("n") > 0, t.unescaped(text)).alias("text"),
                         F.col("s_start").isNotNull().alias("learned"), "formatted_chars")


def digest(turns: DataFrame) -> DataFrame:
    """The contract's columns from ``read_back``."""
    real, learned = F.col("n") > 0, F.col("learned")
    every = F.sort_array(F.collect_list(F.when(real, F.struct("n", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("x")))))
    loss = F.sort_array(F.collect_list(F.when(learned, F.struct("n", F.col("text").alias("x")))))
    got = turns.groupBy("conv_id").agg(
        F.count(F.when(real, 1)).alias("n_turns"), F.array_join(F.transform(every, lambda x: x.x), "").alias("all_text"),
        F.array_join(F.transform(loss, lambda x: x.x), "").alias("loss"), F.max("formatted_chars").alias("formatted_chars"))
    return got.select("conv_id", "n_turns", F.sha2(F.col("all_text").cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"),
                      F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
