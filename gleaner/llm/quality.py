"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

A rule names a metric and the closed interval it must lie in, for texts of at least `min_words` words. A document is
kept when no rule is broken; `failed_rules` lists those that are.

Cases: a null or empty text has no words, ratios of zero, and breaks the word-count rule; repeated rows are judged
alike; an empty table gives an empty result; other columns pass through `filter_documents` untouched, whatever their
names. Texts are never cut; a window of words is compared by its 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import ROW, packed

# The white space that separates words, and what counts as a symbol.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on are this from at or an have not you"
    " der die das und in zu den von mit ist des sich auf für im dem nicht ein eine als auch es an"
    " le la les de des et en un une du que qui dans pour est pas sur au par avec il ce"
    " el los las y del se con una por no su para lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


BASE_RULES = (
    Rule("few_words", "n_words", low=10),
    Rule("repeated_words", "repeat_percent", high=20),
)
# After published web-text rules, widened where short clean texts of four languages would break them.
RULES = (
    Rule("word_length", "mean_word_length", 2, 12),
    Rule("symbols", "symbol_ratio", high=0.2),
    Rule("letters", "letter_word_ratio", low=0.5),
    Rule("shouting", "upper_ratio", high=0.6),
    Rule("dup_lines", "dup_line_ratio", high=0.45),
    Rule("stop_words", "stop_word_ratio", low=0.005, min_words=200),
)


def broken(rule: Rule) -> Column:
    """True where the rule applies and its metric is outside."""
    metric, bounds = F.col(rule.metric), []
    if rule.low is not None:
        bounds.append(metric < F.lit(rule.low))
    if rule.high is not None:
        bounds.append(metric > F.lit(rule.high))
    outside = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
    return outside & (F.col("n_words") >= rule.min_words) if rule.min_words else outside


def names_of_broken(rules: tuple[Rule, ...]) -> Column:
    """The compiled table: names of the broken rules, in order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def sorted_windows(words: Column) -> Column:
    """(hash, position) of every window of words, sorted; null for texts shorter than a window."""
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashed = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    placed = F.sort_array(F.transform(starts, lambda i: F.struct(hashed(i).alias("h"), i.alias("i"))))
    return F.when(F.size(words) >= WINDOW, placed)


def repeated_positions(placed: Column) -> Column:
    """Positions of windows equal to a neighbour in sorted order, ascending; each covers its words up to the next one."""
    again = F.filter(
        placed,
        lambda x, k: (x["h"] == F.get(placed, k - 1)["h"]) | (x["h"] == F.get(placed, k + 1)["h"]),
    )
    return F.sort_array(F.transform(again, lambda x: x["i"]))


def settled(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with columns that are evaluated once, here.

    A one-row `inline` stands between them and what uses them; otherwise the optimizer would copy them into each use and into
    filters pushed below, and their own parts into them.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def measured(frame: DataFrame, text: Column) -> DataFrame:
    """The frame with the metrics of a text column added."""
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    trimmed = F.btrim(F.col("__text"), F.lit(SPACE))
    letters = F.lit("\\p{L}")
    stops = list(dict.fromkeys(STOP_WORDS))
    rows = settled(frame, {"__text": F.coalesce(text.cast("string"), F.lit(""))})
    rows = settled(
        rows,
        {
            "__words": F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_CLASS)).otherwise(
                F.array().cast("array<string>")
            ),
            "__lines": F.filter(F.split("__text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0),
        },
    )
    rows = settled(rows, {"__placed": sorted_windows(F.col("__words"))})
    rows = settled(rows, {"__again": F.coalesce(repeated_positions(F.col("__placed")), F.array().cast("array<int>"))})
    gap = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__again", k + 1) - p, F.lit(WINDOW)))
    rows = settled(
        rows,
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.length(F.translate("__text", SPACE, "")).cast("bigint"),
            "n_symbols": (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("bigint"),
            "n_lines": F.size("__lines").cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.aggregate(
                F.transform("__again", gap), F.lit(0).cast("bigint"), lambda total, x: total + x
            ),
            "__letter_words": F.size(F.filter("__words", lambda w: F.rlike(w, letters))),
            "__latin": F.size(F.filter("__words", lambda w: F.rlike(w, F.lit("[A-Za-z]")))),
            "__stops": F.size(F.filter("__words", lambda w: F.lower(w).isin(stops))),
            "__upper": F.length("__text") - F.length(F.translate("__text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        },
    )
    return rows.withColumns(
        {
            "mean_word_length": ratio(F.col("word_chars"), F.col("n_words")),
            "symbol_ratio": ratio(F.col("n_symbols"), F.col("n_words")),
            "letter_word_ratio": ratio(F.col("__letter_words"), F.col("n_words")),
            # The listed languages are written in Latin letters; texts in others are not judged by their stop words.
            "stop_word_ratio": F.when(2 * F.col("__latin") >= F.col("n_words"), ratio(F.col("__stops"), F.col("n_words"))).otherwise(1.0),
            "upper_ratio": ratio(F.col("__upper"), F.col("word_chars")),
            "dup_line_ratio": ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_percent": ratio(100 * F.col("n_repeat_words"), F.col("n_words")),
        }
    ).drop("__text", "__words", "__lines", "__placed", "__again", "__letter_words", "__latin", "__stops", "__upper")


def judge(frame: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES, text_col: str = "text") -> DataFrame:
    """(row struct `__row`, metrics, failed_rules, kept) for every row."""
    rows = measured(packed(frame), F.col(ROW)[text_col])
    return rows.withColumn("failed_rules", names_of_broken(rules)).withColumn("kept", F.size("failed_rules") == 0)


def filter_documents(frame: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + RULES, text_col: str = "text") -> DataFrame:
    """The rows that break no rule, with the columns they came with."""
    return judge(frame, rules, text_col).where("kept").select(f"{ROW}.*")
