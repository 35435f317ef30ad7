"""Chat formatting as relational expressions: one string and a loss mask for each conversation.

The turns of a conversation are collected as structs, sorted, and merged where neighbours have one
role; arrays of pieces are joined to the formatted text, and running sums of their lengths give the
byte spans of the loss mask. Everything is Spark expressions. The format can be read back: control
strings inside texts are escaped, so markers in the output are the template's own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "\\"
CHUNK = 64  # sizes summed at once


@dataclass(frozen=True)
class Template:
    """Markers of a chat format. `roles`: role, marker before its text, marker after it. Any other
    role is written between the first two markers of `other`. `joint` stands between the texts of
    merged turns. Markers without their outer white space are the control strings."""

    begin: str = "<s>"
    roles: tuple[tuple[str, str, str], ...] = (
        ("system", "<<SYS>>\n", "\n<</SYS>>\n\n"),
        ("user", "[INST] ", " [/INST]"),
        ("assistant", "[SAY] ", " </s>"),
    )
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
    joint: str = "[ALSO]"
    learned: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        markers = [self.begin, self.joint, *self.other, *(m for _, *pair in self.roles for m in pair)]
        controls = tuple(dict.fromkeys(m.strip() for m in markers))
        object.__setattr__(self, "controls", controls)
        if any(len(c) < 2 or ESCAPE in c for c in controls):
            raise ValueError("a control string has two characters or more and no backslash")
        for a in controls:
            for b in controls:
                overlap = any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b))))
                if overlap or a != b and a in b:
                    raise ValueError(f"control strings {a!r} and {b!r} overlap: the format could not be read back")

    def opening(self, role: Column) -> Column:
        marker = F.concat(F.lit(self.other[0]), self.escaped(role), F.lit(self.other[1]))
        for name, before, _ in self.roles:
            marker = F.when(role == name, F.lit(before)).otherwise(marker)
        return marker

    def closing(self, role: Column) -> Column:
        marker = F.lit(self.other[2])
        for name, _, after in self.roles:
            marker = F.when(role == name, F.lit(after)).otherwise(marker)
        return marker

    def escaped(self, text: Column) -> Column:
        """Backslashes doubled, and one put behind the first character of every control string."""
        rests: dict[str, list[str]] = {}
        for c in self.controls:
            rests.setdefault(c[0], []).append(quoted(c[1:]))
        heads = "|".join(f"{quoted(first)}(?={'|'.join(some)})" for first, some in rests.items())
        return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), f"({heads})", r"$1\\")


def quoted(text: str) -> str:
    return re.sub(r"[^\w\s]", lambda m: "\\" + m[0], text)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def offsets(sizes: Column) -> Column:
    """The sum of the sizes before each item, of a non-empty array. In chunks: an array grown item
    by item takes time with the square of its length."""

    def running(items: Column, first: Column) -> Column:
        return F.aggregate(items, F.array(first), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))

    zero = F.lit(0).cast("long")
    chunks = F.transform(F.sequence(F.lit(1), F.size(sizes), F.lit(CHUNK)), lambda at: F.slice(sizes, at, F.lit(CHUNK)))
    bases = running(F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, b: a + b)), zero)
    sums = F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), lambda c, base: F.slice(running(c, base), F.lit(1), F.size(c)))
    return F.flatten(sums)


def formatted(turns: DataFrame, template: Template = Template(), conv_column: str = "conv_id", turn_column: str = "turn",
              role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv_id, formatted, loss) for each conversation.

    loss: the byte spans (start, end) of `formatted` in UTF-8 that a model is to learn from, one for
    each text of a learned role, in order. Turns go by turn, a NULL one first, ties by role and text;
    repeated rows all stay. A NULL text or role is an empty one; an empty text has an empty span. Rows
    with a NULL conversation are one conversation, as in GROUP BY. An empty table gives no rows.
    Other columns are left out. A conversation is one row of the output and is built in one task.
    """
    rows = turns.select(F.col(conv_column).alias("conv_id"), F.struct(
        F.col(turn_column).alias("turn"), F.coalesce(F.col(role_column), F.lit("")).alias("role"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).alias("row"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))

    turns_, starts = F.col("turns"), F.col("starts")
    fresh = F.transform(turns_, lambda t, i: F.when((i == 0) | (t["role"] != F.get(turns_, i - 1)["role"]), i + 1))
    whole = whole.withColumn("starts", F.array_compact(fresh))
    # neighbours of one role are one block: the places from one start to before the next
    after = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(turns_) + 1))
    # single look-ups: slice() of an array inside a lambda reads the whole array each time
    blocks = F.zip_with(starts, after, lambda a, b: F.transform(F.sequence(a, b - 1), lambda i: F.get(turns_, i - 1)))

    def piece(text: Column, learned: Column | bool = False) -> Column:
        return F.struct(text.alias("text"), (F.lit(learned) if isinstance(learned, bool) else learned).alias("learned"))

    def pieces(block: Column) -> Column:
        role = F.get(block, F.lit(0))["role"]
        inner = F.transform(block, lambda t, i: F.array(
            piece(F.when(i > 0, F.lit(template.joint)).otherwise(F.lit(""))), piece(template.escaped(t["text"]), t["role"].isin(*template.learned))))
        return F.concat(F.array(piece(template.opening(role))), F.flatten(inner), F.array(piece(template.closing(role))))

    first = F.array(piece(F.lit(template.begin)))
    whole = whole.withColumn("pieces", F.concat(first, F.flatten(F.transform(blocks, pieces))))
    whole = whole.withColumn("sizes", F.transform("pieces", lambda p: F.octet_length(p["text"]).cast("long")))
    placed = F.arrays_zip("pieces", "sizes", offsets(F.col("sizes")).alias("at"))
    spans = F.transform(F.filter(placed, lambda x: x["pieces"]["learned"]), lambda x: F.struct(x["at"].alias("start"), (x["at"] + x["sizes"]).alias("end")))
    return whole.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), spans.alias("loss"))


def turns_of(text: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation, merged ones apart again."""
    ways = [*(pair for _, *pair in template.roles), template.other[::2]]
    pattern = "(?s)" + "|".join(f"{quoted(before)}.*?{quoted(after)}" for before, after in ways)

    def turns(block: Column) -> Column:
        before, middle, after = template.other
        inner = block.substr(F.lit(len(before) + 1), F.length(block) - len(before) - len(after))
        role = F.substring_index(inner, middle, 1)
        body = inner.substr(F.length(role) + len(middle) + 1, F.length(inner))
        role = unescaped(role)
        for name, before, after in template.roles:
            own = block.startswith(before)
            body = F.when(own, block.substr(F.lit(len(before) + 1), F.length(block) - len(before) - len(after))).otherwise(body)
            role = F.when(own, F.lit(name)).otherwise(role)
        return F.transform(F.split(body, quoted(template.joint)), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), turns))


def learned_text(text: Column, loss: Column) -> Column:
    """What lies under the loss mask, unescaped: the spans one after the other."""

    def under(data: Column) -> Column:
        return F.transform(loss, lambda s: unescaped(F.substring(data, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string")))

    # the bytes as the item of an array, so that they are made once and not for every span
    return F.array_join(F.get(F.transform(F.array(text.cast("binary")), under), F.lit(0)), "")


def digests(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    read = chats.withColumn("turns", turns_of(F.col("formatted"), template)).withColumn("learned", learned_text(F.col("formatted"), F.col("loss")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def with_probe(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The turns, and conversation -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


def oracle(template: Template = Template()) -> str:
    """The same digests in SQL, from the turns themselves; the length of the format from its rules."""

    def sql(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def length(of: str) -> str:
        return f"(length({of}) + length({of}) - length(replace({of}, '\\', '')) + len(regexp_extract_all({of}, {sql('|'.join(map(quoted, template.controls)))})))"

    known = " ".join(f"WHEN {sql(name)} THEN {len(a) + len(b)}" for name, a, b in template.roles)
    frame = f"CASE role WHEN NULL THEN 0 {known} ELSE {sum(map(len, template.other))} + {length('role')} END"
    learned = ", ".join(map(sql, template.learned))
    return f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
near AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM rows)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role IN ({learned})), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role IN ({learned})), '')) AS loss_sha256,
    CAST({len(template.begin)} + sum({length('text')} + CASE WHEN before = role THEN {len(template.joint)} ELSE {frame} END) AS BIGINT) AS formatted_chars
FROM near GROUP BY conv_id"""
