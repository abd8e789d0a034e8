"""Fill-in-the-middle transformation by counted patterns.

A text is a run of units (lines with their line ends). The number n of units comes from one
``regexp_count``; the two cuts lie behind the a-th and the b-th unit. A pattern made for the
row, ``unit{a}`` and ``unit{b-a}`` with possessive counts and the rest, takes prefix, middle
and suffix in one match, whose replacement writes them in the wanted order. Possessive counts
never go back, so a match is one pass over the text without recursion, however many units.

Only SQL functions take part, in one projection: no shuffle, no state, nothing but the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick

#: A line with its end, or the last line without one.
LINE = r"[^\n]*+\n|[^\n]++"
#: Signs that stand before prefix, suffix and middle in the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(seed: int, doc_id: Column, count: int) -> list[Column]:
    """The first 32-bit numbers of the SHA-256 of ``seed:doc_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(count)
    ]


def _split(unit: str, first: Column, second: Column) -> Column:
    """The pattern that takes ``first`` units, ``second`` units and the rest."""

    def group(count: Column) -> list[Column]:
        return [F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)")]

    return F.concat(F.lit(r"(?s)\A"), *group(first), *group(second), F.lit(r"(.*)\z"))


def transform(
    docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = 7, unit: str = LINE
) -> DataFrame:
    """Reorders each text of ``docs`` (doc_id, text) for learning to fill in the middle.

    Returns per row doc_id, n (units), form, prefix_chars, middle_chars (code points) and
    output. ``rate`` of 100 texts are transformed, ``spm`` of 100 of these with the suffix
    first; both, and the cuts, follow from ``seed`` and doc_id alone. Form ``psm`` is
    ``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``. ``plain`` is the
    text as it is: an empty one, one that holds a sign itself, or one that is not drawn; its
    prefix_chars and middle_chars are null.

    A null text is empty, a null doc_id draws as an empty one. Rows with equal doc_id and text
    give equal rows. Texts may be as long as a string may be. Further columns of ``docs`` take
    no part, whatever their names; an empty table gives an empty one.
    """
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    h1, h2, h3, h4 = draws(seed, F.col("doc_id"), 4)
    cut = rows.select(
        "doc_id",
        "text",
        F.regexp_count("text", F.lit(unit)).cast("long").alias("n"),
        h1.alias("h1"),
        h2.alias("h2"),
        (h3 % 100 >= rate).alias("left_out"),
        (h4 % 100 < spm).alias("suffix_first"),
    )
    one, two = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    signed = F.lit(False)
    for sign in (PREFIX, SUFFIX, MIDDLE):
        signed = signed | F.contains("text", F.lit(sign))
    plain = (F.col("text") == "") | signed | F.col("left_out")
    form = F.when(plain, "plain").when(F.col("suffix_first"), "spm").otherwise("psm")
    cut = cut.select(
        "doc_id", "text", "n", form.alias("form"), F.least(one, two).alias("a"),
        F.greatest(one, two).alias("b"),
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"
    )
    moved = F.regexp_replace("text", _split(unit, F.col("a"), F.col("b") - F.col("a")), order)
    done = cut.select(
        "doc_id",
        "n",
        "form",
        F.when(F.col("form") == "plain", F.col("text")).otherwise(moved).alias("output"),
    )
    # a text in which no sign occurs cannot make one up together with a sign beside it
    at_prefix, at_suffix, at_middle = (
        F.locate(sign, F.col("output")).cast("long") for sign in (PREFIX, SUFFIX, MIDDLE)
    )
    prefix_end = F.when(F.col("form") == "spm", at_middle).otherwise(at_suffix)
    reordered = F.col("form") != "plain"
    return done.select(
        "doc_id",
        "n",
        "form",
        F.when(reordered, prefix_end - at_prefix - len(PREFIX)).alias("prefix_chars"),
        F.when(reordered, F.length("output") - at_middle - len(MIDDLE) + 1).alias("middle_chars"),
        "output",
    )


def restored(output: Column, form: Column) -> Column:
    """The original text, from what ``transform`` made of it and the form."""
    psm = rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\z"
    spm = rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\z"
    return (
        F.when(form == "psm", F.regexp_replace(output, psm, "$1$3$2"))
        .when(form == "spm", F.regexp_replace(output, spm, "$2$3$1"))
        .otherwise(output)
    )
