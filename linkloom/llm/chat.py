"""Chat formatting with typed content parts, by DataFrame operations alone.

A message's content is an array of parts, each text, image, audio or document. A visitor flattens them in order: text
is escaped; any other part becomes a numbered placeholder ``<|kind:number|>``, its reference is recorded, and the tokens it
will expand to are counted by kind and units (tiles, seconds, pages).

Template: ``<|turn|>role\\ncontent<|end|>\\n`` for each turn, in order of ``turn`` (ties: by role, then content).
Escaping writes ``&``, ``<`` and ``[`` as ``&amp;``, ``&lt;`` and ``&#91;`` (and a line break in a role as ``&#10;``),
so neither this template's control strings nor those of others (``</s>``, ``[INST]``) can stand in a text, and it is
undone exactly. A kind is escaped in the same way, as are its ``|``, ``:`` and line breaks, so no kind can close its placeholder. The loss mask covers the content of assistant turns, escaped as it stands in the output.

Each conversation is one output row; positions are running sums over its turns, made before the turns are gathered.

Defined cases: null text is empty, null role is the empty role, null parts are no parts; a null conv_id is a
conversation like any other; a part of null kind is text; a part of a kind that ``EXPANDS`` doesn't have is kept as a
placeholder with null ``tokens``, which ``expanded_tokens`` counts as 0; repeated rows are turns each; no rows give no conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
#: Tokens that one unit of an attachment expands to.
EXPANDS = {"image": 256, "audio": 25, "document": 512}
PARTS = "array<struct<kind:string,text:string,ref:string,units:int>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))


def unescape(text: Column) -> Column:
    plain = F.replace(F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&#91;"), F.lit("[")), F.lit("&lt;"), F.lit("<"))
    return F.replace(plain, F.lit("&amp;"), F.lit("&"))


def _kind(kind: Column) -> Column:
    """A kind inside a placeholder."""
    got = escape(kind)
    for mark, code in (("|", "&#124;"), (":", "&#58;"), ("\n", "&#10;")):
        got = F.replace(got, F.lit(mark), F.lit(code))
    return got


def text_parts(text: Column) -> Column:
    """Plain text as one part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))).cast(PARTS)


def _cost(part: Column) -> Column:
    each = F.lit(None).cast("int")
    for kind, n in EXPANDS.items():
        each = F.when(part["kind"] == kind, F.lit(n)).otherwise(each)
    return (each * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))).cast("long")


def format_conversations(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``messages``: conv_id, turn, role, parts. Returns conv_id, formatted, loss (turn from 0, ``at``: where it starts
    in its turn's segment, ``start``: in the whole, length), attachments (turn, number, kind, ref, tokens) and
    ``expanded_tokens``."""
    is_text = lambda p: F.coalesce(p["kind"], F.lit("text")) == "text"
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(F.filter("parts", lambda p: p.isNotNull()), F.array().cast(PARTS)).alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "flat", "parts")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    # numbers of attachments run through the conversation, so the turn's first number comes before its content
    rows = rows.withColumn("files", F.filter("parts", lambda p: ~is_text(p)))
    rows = rows.withColumn("flat", F.array_join(F.transform("parts", lambda p: F.when(is_text(p), F.coalesce(p["text"], F.lit(""))).otherwise(F.lit(""))), ""))
    rows = rows.withColumn("k", F.coalesce(F.sum(F.size("files")).over(upto), F.lit(0)).cast("int")).withColumn("n", F.row_number().over(order) - 1)
    number = lambda i: F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i + 1), lambda p: ~is_text(p))) + F.col("k")
    content = F.array_join(F.transform("parts", lambda p, i: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _kind(p["kind"]), F.lit(":"), number(i).cast("string"), F.lit("|>")))), "")
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    rows = rows.withColumn("head", F.length(head)).withColumn("content", content)
    rows = rows.withColumn("segment", F.concat(head, F.col("content"), F.lit(END + "\n")))
    place = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum(F.length("segment")).over(place), F.lit(0)))
    span = F.struct(F.col("n").alias("turn"), F.col("head").alias("at"), (F.col("before") + F.col("head")).cast("long").alias("start"), F.length("content").alias("length"))
    files = F.transform("files", lambda p, i: F.struct(F.col("n").alias("turn"), (i + 1 + F.col("k")).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), _cost(p).alias("tokens")))
    return rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "segment"))), lambda x: x["segment"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role").isin(*loss_roles), span))).alias("loss"),
        F.array_sort(F.flatten(F.collect_list(files))).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + F.coalesce(a["tokens"], F.lit(0))))


def segments(formatted: Column) -> Column:
    """The turns' segments, read back."""
    return F.filter(F.split(formatted, r"(?<=<\|end\|>\n)(?=<\|turn\|>|\z)"), lambda s: s != "")


def parse(segment: Column) -> Column:
    """(role, text) of a segment; placeholders are no text."""
    body = F.substring(segment, F.lit(len(TURN) + 1), F.length(segment) - len(TURN) - len(END) - 1)
    role = F.substring_index(body, "\n", 1)
    text = F.substring(body, F.length(role) + 2, F.length(body))
    return F.struct(unescape(role).alias("role"), unescape(F.regexp_replace(text, r"<\|[^|:<]*:\d+\|>", "")).alias("text"))


def loss_text(segs: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(F.element_at(segs, s["turn"] + 1), s["at"] + 1, s["length"]))), "")


_PROBE = "</s>[INST] ok [/INST]"


def query(spark, sf_dir):
    """op7: digests of every conversation, read back from the formatted text."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_PROBE).alias("text"))
    got = format_conversations(rows.unionByName(more).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts")))
    got = got.withColumn("segs", segments(F.col("formatted"))).withColumn("turns", F.transform("segs", parse)).withColumn("learnt", loss_text(F.col("segs"), F.col("loss")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'
), e AS (
  SELECT *, length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS n_text,
    length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) AS n_role FROM t
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN) + len(END) + 2} + n_role + n_text)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
