"""Quality rules: a threshold table compiled into one Spark projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm.common import table, words_of

MIN_WORDS = 50
WINDOW = 3

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by this are from or an at not have he "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er "
    "le la les de des et un une du en que qui dans pour par sur est pas il au avec ce plus "
    "el los las y del se con no su al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= measure <= high``; a missing bound is open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        value = F.col(self.measure)
        low = F.lit(True) if self.low is None else value >= self.low
        return low if self.high is None else low & (value <= self.high)


# Thresholds over the measures that ``measured`` computes.
RULES = (
    Rule("mean word length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols per word", "symbol_ratio", None, 0.1),
    Rule("share of stop words", "stop_ratio", 0.04, None),
    Rule("share of repeated lines", "dup_line_ratio", None, 0.5),
    Rule("exclamation marks per word", "shout_ratio", None, 0.2),
)


def _repeat_words() -> Column:
    """From ``_windows``, the exact repeats, to the number of words that some repeated window covers."""
    steps = F.transform(
        "_repeats",
        lambda p, j: F.when(j == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), p - F.get("_repeats", j - 1))),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the word, symbol, line and repetition measures of each whole text.

    Windows of three words are compared in linear-logarithmic time: hashes (32 bits) and positions (31 bits) are
    packed into one long and sorted, neighbours with equal hashes are compared as text. So the counts are exact for
    any text, and a hash collision costs only a comparison.
    """
    kept = docs.columns
    low32 = F.lit(0xFFFFFFFF).cast("long")
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select(*[F.col(f"`{c}`") for c in kept], text.alias("_text"), words_of(F.col("text")).alias("_words"))
    two = one.select(
        "*",
        F.size("_words").cast("long").alias("_n"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"),
        F.when(
            F.size("_words") >= WINDOW,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.size("_words") - WINDOW),
                    lambda i: F.shiftleft(
                        F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]).bitwiseAND(low32), 31
                    ).bitwiseOR(i.cast("long")),
                )
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_keys"),
    )

    def same_hash(j: Column, key: Column) -> Column:
        return F.coalesce(F.shiftright(F.get("_keys", j), 31) == F.shiftright(key, 31), F.lit(False))

    position = F.lit(0x7FFFFFFF).cast("long")
    three = two.select(
        "*",
        F.sort_array(
            F.transform(
                F.filter("_keys", lambda key, j: same_hash(j - 1, key) | same_hash(j + 1, key)),
                lambda key: F.struct(
                    F.concat_ws(
                        " ", *[F.get("_words", key.bitwiseAND(position).cast("int") + k) for k in range(WINDOW)]
                    ).alias("w"),
                    key.bitwiseAND(position).alias("p"),
                ),
            )
        ).alias("_windows"),
    )

    def same_window(j: Column, window: Column) -> Column:
        return F.coalesce(F.get("_windows", j)["w"] == window["w"], F.lit(False))

    four = three.select(
        "*",
        F.sort_array(
            F.transform(
                F.filter("_windows", lambda x, j: same_window(j - 1, x) | same_window(j + 1, x)), lambda x: x["p"]
            )
        ).alias("_repeats"),
    )
    # As a generator's output: a filter on these stops here. Pushed below, it would put whole arrays into the
    # functions that run for each element.
    counted = four.select(
        *[F.col(f"`{c}`") for c in kept],
        F.inline_outer(
            F.array(
                F.struct(
                    F.col("_n").alias("_n_words"),
                    F.length(F.array_join("_words", "")).cast("long").alias("_word_chars"),
                    F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("_n_symbols"),
                    (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_n_dup_lines"),
                    _repeat_words().alias("_n_repeat_words"),
                    F.size("_lines").alias("_n_lines"),
                    F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("_n_stop"),
                    F.regexp_count("_text", F.lit("!")).alias("_n_shouts"),
                )
            )
        ),
    )
    words, lines = F.greatest(F.col("_n_words"), F.lit(1)), F.greatest(F.col("_n_lines"), F.lit(1))
    return counted.select(
        "*",
        (F.col("_word_chars") / words).alias("mean_word_chars"),
        (F.col("_n_symbols") / words).alias("symbol_ratio"),
        (F.col("_n_stop") / words).alias("stop_ratio"),
        (F.col("_n_dup_lines") / lines).alias("dup_line_ratio"),
        (F.col("_n_shouts") / words).alias("shout_ratio"),
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio", "shout_ratio")


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: its counts (long), ratios, ``base_failed``, ``failed_rules`` and ``kept``.

    ``docs`` needs ``doc_id`` and ``text``; its other columns, whatever their names, are ignored. Repeated rows give
    repeated results. Null, empty and blank texts have no words, every count 0, and fail the base rule. Texts of any
    length are read whole, in one narrow projection: no shuffle and no state outside the row.
    """
    counted = measured(docs.select("doc_id", "text"))
    base = (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words"))
    failed = F.array_compact(F.array(*[F.when(~rule.passes(), F.lit(rule.name)) for rule in rules]))
    judged = counted.select(
        "doc_id", *[F.col(f"_{c}").alias(c) for c in COUNTS], *RATIOS, base.alias("base_failed"), failed.alias("failed_rules")
    )
    return judged.select("*", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))


def kept_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are; one narrow pass, no join."""
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    judged = quality_rules(docs.select(row.alias("doc_id"), "text"), rules)
    return judged.where("kept").select(*[F.col(f"doc_id.c{i}").alias(c) for i, c in enumerate(names)])


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept")


_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP1_SQL = f"""
with t as (
  select doc_id, coalesce(text, '') as text,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls
  from documents),
numbered as (select *, row_number() over () as rid from t),
windows as (
  select rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] as w
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as p from numbered)),
repeated as (
  select rid, p from (select rid, p, count(*) over (partition by rid, w) as n from windows) where n >= 2),
covered as (
  select rid, sum(case when prev is null then 3 else least(3, p - prev) end) as n
  from (select rid, p, lag(p) over (partition by rid order by p) as prev from repeated) group by rid),
counts as (
  select doc_id, cast(len(ws) as bigint) as n_words,
         cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(n, 0) as bigint) as n_repeat_words,
         greatest(len(ws), 1) as w, greatest(len(ls), 1) as l,
         len(list_filter(ws, lambda x: lower(x) in ({_STOP_LIST}))) as stops,
         length(text) - length(replace(text, '!', '')) as shouts
  from numbered left join covered using (rid)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and word_chars / w between 2.0 and 20.0 and n_symbols / w <= 0.1 and stops / w >= 0.04
       and n_dup_lines / l <= 0.5 and shouts / w <= 0.2 as kept
from judged
"""
