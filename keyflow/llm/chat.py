r"""Chat formatting with DataFrame functions only.

Template: ``<|turn ROLE|>TEXT<|end|>`` per block; a block holds all adjacent turns
of one role, their texts parted by ``<|part|>``. Control strings are those that
start with ``<|`` or end with ``|>``. In roles and texts ``\`` becomes ``\0``,
``<|`` becomes ``\1`` and ``|>`` becomes ``\2``, so that no text can form a control
string and reading back restores every text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
OPEN, CLOSE, PART, END = "<|turn ", "|>", "<|part|>", "<|end|>"
#: Lengths are summed, and texts read, in pages of so many turns and characters.
SUM_TURNS, PAGE_CHARS = 128, 4096


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\0"), ("<|", "\\1"), ("|>", "\\2")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in (("|>", "\\2"), ("<|", "\\1"), ("\\", "\\0")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once a row: a generator stands between them
    and what uses them. Without it, an array that is used once, but inside a function
    over elements, would be computed again for every element."""
    return df.select(*df.columns, F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__settled")).select(*df.columns, "__settled.*")


def format_conversations(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id, formatted, loss_spans`` for each conversation of ``turns``.

    ``turns`` has ``conv_id, turn, role, text``. Turns are sorted by turn, then role,
    then text; repeated rows stay. Null turns come first, a null role or text is
    empty, rows with a null conv_id form one conversation. ``loss_spans`` are the
    [start, stop) character ranges of the escaped texts of ``loss_role``.
    A conversation is one output row and is gathered whole; nothing else is.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = turns.select("conv_id", said.alias("s")).groupBy("conv_id").agg(F.collect_list("s").alias("said"))
    # Layers, each used by name in the next, so that nothing is computed twice or per element.
    told = settled(
        told.withColumnRenamed("said", "__raw"),
        said=F.transform(F.array_sort("__raw"), lambda x: F.struct(escape(x["role"]).alias("role"), escape(x["text"]).alias("text"), x["role"].eqNullSafe(F.lit(loss_role)).alias("loss"))),
    ).drop("__raw")
    number = F.sequence(F.lit(0), F.size("said") - 1)
    told = settled(told, opens=F.filter(number, lambda i: (i == 0) | (F.get("said", i)["role"] != F.get("said", i - 1)["role"])))
    # The turns of a block: from its opening turn to the next one's.
    block = lambda a, k: F.slice("said", a + 1, F.coalesce(F.get("opens", k + 1), F.size("said")) - a)
    shown = F.array_join(
        F.transform("opens", lambda a, k: F.concat(F.lit(OPEN), F.get("said", a)["role"], F.lit(CLOSE), F.array_join(F.transform(block(a, k), lambda x: x["text"]), PART), F.lit(END))), ""
    )
    opening = F.flatten(F.transform("opens", lambda a, k: F.transform(block(a, k), lambda x, i: i == 0)))
    told = settled(told, formatted=shown, opening=opening)
    # Characters before each text since the text before it, and the text's own.
    told = settled(told, head=F.transform(
        "said", lambda x, i: F.when(F.get("opening", i), F.length(x["role"]) + len(OPEN) + len(CLOSE) + F.when(i > 0, len(END)).otherwise(0)).otherwise(len(PART))
    ))
    told = settled(told, steps=F.zip_with("head", "said", lambda h, x: (h + F.length(x["text"])).cast("bigint")))
    added = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    last = F.floor((F.size("steps") - 1) / SUM_TURNS).cast("int")
    told = settled(told, pages=F.transform(F.sequence(F.lit(0), last), lambda p: added(F.slice("steps", p * SUM_TURNS + 1, F.lit(SUM_TURNS)))))
    told = settled(told, before=F.transform("pages", lambda x, p: added(F.slice("pages", F.lit(1), p))))
    page = lambda i: F.floor(i / SUM_TURNS).cast("int")
    start = lambda i: F.get("before", page(i)) + added(F.slice("steps", page(i) * SUM_TURNS + 1, i - page(i) * SUM_TURNS)) + F.get("head", i)
    told = settled(told, starts=F.transform("said", lambda x, i: F.when(x["loss"], start(i))))
    ranges = F.zip_with("starts", "said", lambda a, x: F.struct(a.cast("bigint").alias("start"), (a + F.length(x["text"])).cast("bigint").alias("stop")))
    return told.select("conv_id", "formatted", F.filter(ranges, lambda r: r["start"].isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")
    return F.flatten(
        F.transform(
            F.transform(blocks, lambda b: F.split(b, r"\|>", 2)),
            lambda halves: F.transform(
                F.split(F.element_at(halves, 2), r"<\|part\|>"),
                lambda t: F.struct(unescape(F.substr(F.element_at(halves, 1), F.lit(len(OPEN) + 1))).alias("role"), unescape(t).alias("text")),
            ),
        )
    )


def with_loss_text(df: DataFrame, formatted: str = "formatted", spans: str = "loss_spans", into: str = "loss") -> DataFrame:
    """``df`` with all text under the loss mask, unescaped, end to end, as column ``into``.

    The text is cut into pages once, so that a span is looked up in its own pages.
    """
    df = settled(df, __pages=F.regexp_extract_all(F.col(formatted), F.lit(f"(?s)(.{{1,{PAGE_CHARS}}})"), F.lit(1)))

    def text(s: Column) -> Column:
        first, last = F.floor(s["start"] / PAGE_CHARS).cast("int"), F.floor((s["stop"] - 1) / PAGE_CHARS).cast("int")
        at, end = (s["start"] % PAGE_CHARS + 1).cast("int"), ((s["stop"] - 1) % PAGE_CHARS + 1).cast("int")
        inside = F.substr(F.get("__pages", first), at, end - at + 1)
        across = F.concat(
            F.substr(F.get("__pages", first), at), F.array_join(F.slice("__pages", first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.substr(F.get("__pages", last), F.lit(1), end)
        )
        return F.when(s["start"] >= s["stop"], "").when(first == last, inside).otherwise(across)

    return df.withColumn(into, F.array_join(F.transform(F.col(spans), lambda s: unescape(text(s))), "")).drop("__pages")


def op5(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    out = format_conversations(turns.unionByName(extra))
    out = with_loss_text(settled(out, turns=read_turns(F.col("formatted"))))
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
         length(replace(replace(replace(role, '\', '\0'), '<|', '\1'), '|>', '\2')) AS role_chars,
         length(replace(replace(replace(text, '\', '\0'), '<|', '\1'), '|>', '\2')) AS text_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN opens THEN role_chars + 16 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
