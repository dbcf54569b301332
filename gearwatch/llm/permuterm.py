"""Spelling variants grouped through permuterm rotations.

A word with a terminator behind it is rotated at every place. The rotation that starts behind the
character at place i reads ``rest $ beginning character``: its first part, without that last
character, is the same for every word that differs from it by another character there, and is the
whole rotation of the word that lacks it. So a replacement or an indel is a prefix range of the
sorted rotations, and near words meet under the key ``rest $ beginning``. A key holds at most one
word without a character at its place and one for each letter there is, so groups are bounded by the
alphabet; each is scanned once and gives every member the count and the best of its near words.
No pairs are written.

One replacement has one place. An indel beside an equal letter has several, of which only the first
one of the letters' run counts, so each near pair meets exactly once.

Words are numbered in code-point order, and only numbers, counts and keys are shuffled. A key above
``LONG`` characters is replaced by its MD5, which keeps rows short however long a word is; the work
for one word is the square of its length.

Defined cases: runs of ``[A-Za-z\\u00C0-\\u00FF]`` are words; only A-Z are lower-cased, so É and é
differ. A null text has no words; a null id is the empty text in the hash that decides deletions.
Repeated rows count each. Of near words with equal counts the first in code-point order is the form.
An empty table gives no rows. Columns other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gearwatch.llm.common import let, ranked, written

#: What a run of letters is, and the letters that are lower-cased.
RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of this many runs loses a character; shortest word; fewest occurrences.
DIVISOR, SHORTEST, FEWEST = 97, 5, 3
#: A form stands at least this many times as often as its variant.
FACTOR = 2
#: Keys above this length travel as digests.
LONG = 96

BARE, OTHER, TWIN = 0, 1, 2


def word_counts(docs: DataFrame, divisor: int = DIVISOR, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text), after deletions; counts are combined before the shuffle."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(1))).alias("run"))
    lowered = runs.select(F.translate("run", UPPER, LOWER).alias("run"), "id")
    drawn = lowered.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shortened = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = drawn.select(F.when(F.col("h") % divisor == 0, shortened).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= fewest)


def rotations(words: DataFrame) -> DataFrame:
    """(key, kind, id, n): each word's 2 * length + 1 places among the sorted rotations.

    ``kind`` tells whether the key leaves out a character, and if so whether that character only
    repeats the one before it.
    """
    places = words.select("id", "n", "word", F.explode(F.sequence(F.lit(0), 2 * F.length("word"))).alias("place"))
    at, skips = F.expr("place div 2").cast("int"), F.col("place") % 2
    before, left_out = F.substr("word", at, F.lit(1)), F.substr("word", at + 1, F.lit(1))
    key = F.concat(F.substr("word", (at + 1 + skips).cast("int")), F.lit("$"), F.substr("word", F.lit(1), at))
    kind = F.when(skips == 0, F.lit(BARE)).when((at > 0) & (before == left_out), F.lit(TWIN)).otherwise(F.lit(OTHER))
    return places.select(F.when(F.length("word") > LONG, F.md5(key)).otherwise(key).alias("key"), kind.cast("tinyint").alias("kind"), "id", "n")


def scanned(rows: DataFrame) -> DataFrame:
    """(id, near, best): for each member of a key its number of near words there and the best of them.

    Members are in order of preference, so the best near word is the first or second one. A word
    without the character is near to all others but the one whose indel belongs to another key.
    """
    member = F.struct("n", (-F.col("id")).alias("back"), "kind")
    groups = rows.groupBy("key").agg(F.sort_array(F.collect_list(member), asc=False).alias("all")).filter(F.size("all") > 1)

    def neighbours(pair: Column) -> Column:
        everyone, others = pair["all"], pair["others"]

        def of(member: Column) -> Column:
            whole = member["kind"] == OTHER
            best = F.when(whole, F.when(everyone[0]["back"] == member["back"], everyone[1]).otherwise(everyone[0])).otherwise(F.get(others, F.lit(0)))
            near = F.when(whole, F.size(everyone) - 1).otherwise(F.size(others))
            return F.struct((-member["back"]).alias("id"), near.cast("long").alias("near"), F.struct(best["n"].alias("n"), best["back"].alias("back")).alias("best"))

        return F.transform(everyone, of)

    both = F.struct("all", F.filter("all", lambda m: m["kind"] == OTHER).alias("others"))
    return groups.select(F.inline(let(both, neighbours))).filter("near > 0")


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of words (id, form) that have a form: the last one of the chain of forms.

    A form stands twice as often as its variant, so a chain has at most 63 steps, and as each round
    doubles the steps taken there are at most seven rounds.
    """
    reached = written(forms.select("id", F.col("form").alias("root")), "form-chain")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("further"))
        step = written(reached.join(ahead, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "form-chain")
        if step.filter("moved").isEmpty():
            return reached
        reached = step.drop("moved")


def variants(counts: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``counts`` (word, n)."""
    words = written(ranked(counts, [F.col("word")], "id", "vocabulary"), "vocabulary")
    found = scanned(rotations(words)).groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    linked = words.join(found, "id", "left").withColumn("linked", F.coalesce(F.col("best.n") >= factor * F.col("n"), F.lit(False)))
    rows = written(linked.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(F.col("linked"), -F.col("best.back")).alias("form")), "variants")
    chains = roots(rows.filter("form IS NOT NULL").select("id", "form"))
    target = words.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    end = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = rows.filter("form IS NOT NULL").join(chains, "id").join(target, "form").join(end, "root")
    return (named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
            .unionByName(rows.filter("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", F.lit(None).cast("long").alias("form_n"))))


def report(docs: DataFrame) -> DataFrame:
    return variants(word_counts(docs.select("doc_id", "text")))
