"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure is a ratio of counts taken inside the row, so the operator is a projection: no shuffle, no user function,
nothing kept between rows. Repeated three-word windows are found by sorting the hashes of the windows of one text; windows
with a repeated hash are then compared as text.

Defined results: a null or empty text has no words and is rejected; repeated rows get equal results, one each; columns of
the input with the name of a result column are replaced by it, other columns stay; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import whole, words

WINDOW = 3
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# repeated hashes of one text beyond which all its windows are sorted, in place of the few that may be repeated
MANY = 512

# Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

# the commonest function words of English, German, French and Spanish
STOP_WORDS = (
    "the of and to in is that for on with as was by at be it this from or are an not "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des du et en un une que qui dans pour par sur au avec est pas plus il elle ce "
    "el los las del y se con una por su para no lo al como más pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """One line of the threshold table: ``low <= top / bottom <= high``, compared without division."""

    name: str
    top: str
    bottom: str
    low: float = 0.0
    high: float = float("inf")

    def holds(self) -> Column:
        over, under = F.col(self.top).cast("double"), F.col(self.bottom).cast("double")
        checks = []
        if self.low > 0:
            checks.append(over >= self.low * under)
        if self.high != float("inf"):
            checks.append(over <= self.high * under)
        result = F.lit(True)
        for check in checks:
            result = result & check
        return result


# ``n_words`` and the like are the counts below; ``one`` is 1, for rules on a count itself
DEFAULT_RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2, high=14),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.01),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("lines that end as bullets or ellipses", "n_loose_lines", "n_lines", high=0.9),
)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_loose_lines", "n_stop_words", "n_repeat_words",
)


def _candidates(tokens: str, hashes: str, dups: str) -> Column:
    """First words of the windows that may occur again: those with a hash that does, or all if many hashes do."""
    at = F.sequence(F.lit(0), F.size(hashes) - 1)
    some = F.filter(at, lambda i: F.array_contains(dups, F.get(hashes, i)))
    found = F.when(F.size(dups) == 0, F.array().cast("array<int>")).when(F.size(dups) > MANY, at).otherwise(some)
    window = lambda i: F.concat_ws(" ", *(F.get(tokens, i + k) for k in range(WINDOW)))
    return F.sort_array(F.transform(found, lambda i: F.struct(window(i).alias("g"), i.alias("i"))))


def _covered(ordered: str) -> Column:
    """Words in the windows that have an equal neighbour in the sorted list."""
    n = F.size(ordered)
    same = lambda j, k: F.coalesce(F.get(ordered, j)["g"] == F.get(ordered, k)["g"], F.lit(False))
    equal = F.filter(F.sequence(F.lit(0), n - 1), lambda j: same(j, j - 1) | same(j, j + 1))
    starts = F.sort_array(F.transform(equal, lambda j: F.get(ordered, j)["i"]))
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct((s + WINDOW).alias("end"), (a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n")),
        lambda a: a["n"],
    )
    return F.when(n < 2, F.lit(0)).otherwise(total)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the counts the rules use, all BIGINT."""
    keep = [c for c in docs.columns if c.lower() not in COUNTS]
    # the row in one column: its names cannot clash with those below
    parts = docs.select(F.struct(*keep).alias("_row"), whole(docs[text]).alias("_text"))
    parts = parts.withColumns(
        {
            "_words": words(F.col("_text")),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")) != ""),
        }
    )
    at = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    hashes = F.transform(at, lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))
    none = F.array().cast("array<bigint>")
    parts = parts.withColumn("_hashes", F.when(F.size("_words") > WINDOW, hashes).otherwise(none))
    parts = parts.withColumn("_sorted", F.sort_array("_hashes"))
    again = F.filter(F.col("_sorted"), lambda h, j: F.coalesce(h == F.get("_sorted", j - 1), F.lit(False)))
    parts = parts.withColumn("_dups", F.array_distinct(again))
    parts = parts.withColumn("_windows", _candidates("_words", "_hashes", "_dups"))
    stop = sorted({form for word in STOP_WORDS for form in (word, word.capitalize())})
    loose = r"^[ \t]*[-*•]|(\.\.\.|…)[ \t\r]*$"
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_loose_lines": F.size(F.filter("_lines", lambda line: line.rlike(loose))),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop))),
        "n_repeat_words": _covered("_windows"),
    }
    return parts.select("_row.*", *(c.cast("bigint").alias(n) for n, c in counts.items()))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """The input with the counts, ``base_failed``, the names of the failed rules and ``kept``."""
    out = measure(docs, text).drop("base_failed", "failed_rules", "kept")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*(F.when(~r.holds(), F.lit(r.name)) for r in rules))) if rules else F.array()
    out = out.withColumns({"base_failed": base, "failed_rules": F.array_join(failed.cast("array<string>"), "; ")})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    marked = docs.select(F.struct(*docs.columns).alias("_row"), docs[text].alias("_body"))
    # a plain filter would be pushed below the counts, each of which would then be computed many times over
    passed = F.explode(F.when(F.col("kept"), F.array("_row"))).alias("_row")
    return judge(marked, rules, "_body").select(passed).select("_row.*")
