"""Line-first cleaning, with DataFrame functions alone.

Each line of a text is tried by the rules of LINE_RULES; lines that fail are removed. A document is rejected if a
base rule on its words fails or if the removed lines hold more than ``most_lost`` of its words' characters.

Base rules: fewer than 50 words, or more than half of the words in three-word windows that occur twice or more
in the text. A word is a run of characters other than the ASCII spaces. Windows are sorted by the bits of a hash that their
places leave, at least 64 - log2(words) of them, and neighbours there with equal bits are compared word by word.

Defined cases: a null text has no words, no lines and fails; an empty text likewise; a null doc_id is carried; repeated
rows are judged alike; an empty table gives no rows. ``measure`` replaces columns of the input with the names of its own, which
all start with ``__rule_``; ``clean`` keeps the input's columns and their values whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS, BARS = "#*$%&|<>", "|>»›•"
MOST_LOST = 0.5

# Fixed phrases that mark a boilerplate line, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "sign up for our newsletter", "click here", "lorem ipsum", "log in to", "skip to content",
)


def _count(x: Column, letters: str) -> Column:
    return F.length(x) - F.length(F.regexp_replace(x, f"[{letters}]", ""))


def _bare(x: Column) -> Column:
    return F.regexp_replace(x, f"{SPACE}+", "")


def line_rules(line: Column) -> dict[str, Column]:
    """Of a line with a word, which rules it fails: too many marks or symbols, or mostly capitals; bars and arrows of menus; fixed phrases."""
    lower, bare = F.lower(line), F.length(_bare(line))
    phrase = F.lit(False)
    for x in BOILERPLATE:
        phrase = phrase | F.contains(lower, F.lit(x))
    # Few lines have a mark, or the 11 capitals that over half of 20 letters come to, so the counts are seldom made.
    odd, loud = line.rlike(f"[!?{SYMBOLS}{BARS}]"), line.rlike(r"\A(?:\P{Lu}*+\p{Lu}){11}")
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    return {
        "punctuation": (odd & ((_count(line, "!?") * 20 > bare) | (_count(line, SYMBOLS) * 20 > bare))) | (loud & (letters >= 20) & (capitals * 2 > letters)),
        "navigation": odd & (_count(line, BARS) * 12 > bare),
        "boilerplate": phrase,
    }


def measure(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """The input with __rule_words, __rule_word_chars, __rule_symbols, __rule_dup_lines, __rule_repeats, __rule_base_failed, __rule_kept and __rule_text (the lines left)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    one = docs.withColumns({"__rule_raw": text}).withColumns(
        {
            "__rule_list": F.array_remove(F.split("__rule_raw", f"{SPACE}+"), ""),
            "__rule_lines": F.filter(F.split("__rule_raw", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
            "__rule_symbols": _count(F.col("__rule_raw"), SYMBOLS).cast("long"),
        }
    )
    words = F.col("__rule_list")
    two = one.withColumns(
        {
            "__rule_words": F.size(words).cast("long"),
            "__rule_word_chars": F.length(F.array_join(words, "")).cast("long"),
            "__rule_bits": F.length(F.bin(F.size(words))),
            # Each window's hash above its place; n - 2 windows.
            "__rule_windows": F.when(
                F.size(words) >= 3,
                F.sort_array(
                    F.transform(
                        F.sequence(F.lit(0), F.size(words) - 3),
                        lambda i: _packed(words, i),
                    )
                ),
            ),
            "__rule_dup_lines": (F.size("__rule_lines") - F.size(F.array_distinct("__rule_lines"))).cast("long"),
            "__rule_left": F.filter("__rule_lines", _passes),
        }
    )
    return _judged(two, most_lost)


def _packed(words: Column, i: Column) -> Column:
    bits = F.length(F.bin(F.size(words)))
    h = F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    return F.call_function("shiftleft", F.call_function("shiftrightunsigned", h, bits), bits).bitwiseOR(i.cast("long"))


def _passes(line: Column) -> Column:
    fails = None
    for rule in line_rules(line).values():
        fails = rule if fails is None else fails | rule
    return ~fails


def _judged(two: DataFrame, most_lost: float) -> DataFrame:
    windows, bits = F.col("__rule_windows"), F.col("__rule_bits")

    def key(x: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, bits)

    def place(x: Column) -> Column:
        return (x - F.call_function("shiftleft", key(x), bits)).cast("int")

    def same(x: Column, y: Column) -> Column:
        alike = key(x.bitwiseXOR(y)) == 0
        for k in range(3):
            alike = alike & (F.get("__rule_list", place(x) + k) == F.get("__rule_list", place(y) + k))
        return F.coalesce(alike, F.lit(False))

    places = F.transform(
        F.filter(windows, lambda x, k: same(x, F.get(windows, k - 1)) | same(x, F.get(windows, k + 1))),
        lambda x: x - F.call_function("shiftleft", key(x), bits),
    )
    three = two.withColumn("__rule_places", F.coalesce(F.sort_array(places), F.array().cast("array<bigint>")))
    repeats = F.aggregate(
        "__rule_places",
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("upto")),
        lambda a, p: F.struct((a["total"] + p + 3 - F.greatest(a["upto"], p)).alias("total"), (p + 3).alias("upto")),
        lambda a: a["total"],
    )
    four = three.withColumns({"__rule_repeats": repeats, "__rule_text": F.array_join("__rule_left", "\n")})
    base = (F.col("__rule_words") < 50) | (100 * F.col("__rule_repeats") > 50 * F.col("__rule_words"))
    whole = F.col("__rule_word_chars")
    lost = F.when(F.size("__rule_left") == F.size("__rule_lines"), F.lit(0)).otherwise(whole - F.length(_bare(F.col("__rule_text"))))
    return four.withColumns({"__rule_base_failed": base, "__rule_kept": ~base & (lost <= most_lost * whole)})


def clean(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """The documents that pass, with the failing lines removed from ``text`` and ``n_chars``, where there is one, brought up to date."""
    # Columns of the input with names of the work columns are named anew meanwhile.
    other = "_" * (1 + max((len(c) for c in docs.columns), default=0))
    clash = {c: other + c for c in docs.columns if c.startswith("__rule_")}
    docs, columns = docs.withColumnsRenamed(clash), docs.columns
    # A condition on the verdict alone would be pushed below the work columns, each written out wherever it is used, inside
    # lambdas too: square work in a text's words. A filter stays above a column that depends on the partition.
    stays = F.col("__rule_kept") & (F.spark_partition_id() >= 0)
    kept = measure(docs, most_lost).withColumn("__rule_stays", stays).filter("__rule_stays")
    new = {"text": F.col("__rule_text")} | ({"n_chars": F.length("__rule_text").cast("long")} if "n_chars" in docs.columns else {})
    return kept.select(*[new[c].alias(c) if c in new else F.col(f"`{clash.get(c, c)}`").alias(c) for c in columns])
