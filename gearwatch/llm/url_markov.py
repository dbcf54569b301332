"""URL verdicts from host and path rules, and from character language models where no rule fits.

Two variable-order Markov models are counted, one over URLs that rules allow and one over those
that rules block. They see the code points of the whole URL: scheme, host (A-Z lower-cased), path,
query and fragment. Contexts of up to ``ORDER`` characters are blended by Witten-Bell weights: a
context that was never seen leaves the decision to the shorter one. A URL without a rule is judged
by its log-likelihood difference per character against a threshold calibrated on a held-out fold.

What is counted grows with the input. Grams are combined before they are shuffled and kept in
written tables, one per context length. A gram meets its shorter form and its context in joins
whose keys have no more rows than there are characters. URLs meet the longest grams in a join;
only grams that make up more than 1 / ``COMMON`` of all positions are broadcast instead, and there
are fewer than ``COMMON`` of these whatever the input.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule, no score and
verdict ``block``. Of two rules that fit and are equally long, the one with the longer host wins.
With no ruled URL of one class the scores are 0 or lean to the other class and the threshold is 0;
a score equal to the threshold is allowed. Repeated rows are judged one by one; an empty table
gives no rows. The control characters that mark both ends count as themselves inside a URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from gearwatch.llm.common import written

# The rules, host and path prefix in one string.
ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]

#: Longest context in characters.
ORDER = 5
#: Grams with a larger share of all positions than 1 / COMMON are broadcast.
COMMON = 10_000
#: What stands before and after a URL.
START, END = "\u0002", "\u0003"
#: Log ratios are whole multiples of 1 / SCALE, so that sums do not depend on the order of rows.
SCALE = 10**9
FOLDS = 5
BIN = 0.02


def host_and_path(url: Column) -> tuple[Column, Column]:
    host, path = _host(_rest(url)), F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _rest(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))


def _host(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def modelled(url: Column) -> Column:
    """What the models read: the URL with its host in lower case; null without ``://``."""
    place, rest = F.instr(url, "://"), _rest(url)
    return F.when(place > 0, F.concat(F.substr(url, F.lit(1), place + 2), _host(rest), F.regexp_extract(rest, r"^[^/?#]*([\s\S]*)", 1)))


def longest_rule(host: Column, path: Column, allow: list[str], block: list[str]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    known = [(r, "allow") for r in allow] + [(r, "block") for r in block]
    for text, says in sorted(known, key=lambda k: (len(k[0]), k[0].index("/"))):  # later ones stand in front
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(text: Column) -> Column:
    """One gram per character and one for the end: the character behind the ``ORDER`` before it."""
    padded = F.concat(F.lit(START * ORDER), text, F.lit(END))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{ORDER + 1}}}))."), F.lit(1))


def gram_counts(urls: DataFrame) -> DataFrame:
    """(gram, n, a, b): places of each gram in all URLs, in accepted and in rejected ones.

    ``urls`` has text and accepted, which is null where a URL is not to be learned from.
    """
    found = urls.select(F.explode(grams(F.col("text"))).alias("gram"), "accepted")
    return written(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("a"),
                                             F.count_if(~F.col("accepted")).alias("b")), "url-grams")


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, n, ratio) for every counted gram: log of the accepted over the rejected probability of its last character.

    The ratio is a whole number of 1 / SCALE. Each context length needs the chances of the next
    shorter one; a gram's shorter form has at most one longer gram per character, and so has a context.
    """
    shorter = None
    for order in range(ORDER + 1):
        own = counts.groupBy(F.right("gram", F.lit(order + 1)).alias("gram")).agg(*[F.sum(x).alias(x) for x in ("n", "a", "b")])
        same_context = W.partitionBy(F.left("gram", F.lit(order)))
        own = own.select("*", F.right("gram", F.lit(order)).alias("short"), *[
            f(F.col(x)).over(same_context).alias(f"{name}_{x}") for x in "ab" for f, name in ((F.sum, "sum"), (lambda y: F.count_if(y > 0), "kinds"))],
            F.count(F.lit(1)).over(same_context).alias("characters"))
        if shorter is None:
            own = own.select("*", *[(1 / F.col("characters")).alias(f"chance_{x}") for x in "ab"])
        else:
            own = own.join(shorter.select(F.col("gram").alias("short"), "chance_a", "chance_b"), "short")
        blended = [F.when(F.col(f"sum_{x}") > 0, (F.col(x) + F.col(f"kinds_{x}") * F.col(f"chance_{x}")) / (F.col(f"sum_{x}") + F.col(f"kinds_{x}")))
                   .otherwise(F.col(f"chance_{x}")).alias(f"chance_{x}") for x in "ab"]
        shorter = written(own.select("gram", "n", *blended), "url-chances")
    return shorter.select("gram", "n", F.round(F.log(F.col("chance_a") / F.col("chance_b")) * SCALE).cast("long").alias("ratio"))


def scores(urls: DataFrame, ratios: DataFrame, common: int = COMMON) -> DataFrame:
    """(row, score): the mean log ratio of the characters of each of ``urls`` (row, text)."""
    total = ratios.agg(F.sum("n").alias("total")).scalar()
    marked = ratios.select("gram", "ratio", (F.col("n") * common > total).alias("is_common"))
    frequent = marked.filter("is_common").select("gram", "ratio")  # fewer than ``common`` rows, as their shares add up to 1 at most
    cells = urls.select("row", F.explode(grams(F.col("text"))).alias("gram")).join(F.broadcast(frequent), "gram", "left")
    rare = cells.filter("ratio IS NULL").select("row", "gram").join(marked.filter("NOT is_common").select("gram", "ratio"), "gram")
    found = cells.filter("ratio IS NOT NULL").select("row", "ratio").unionByName(rare.select("row", "ratio"))
    return found.groupBy("row").agg((F.sum("ratio") / F.count(F.lit(1)) / SCALE).alias("score"))


def threshold(held: DataFrame) -> float:
    """The cut with the least sum of both error shares, of equally good ones the nearest to 0; ``held`` has score and verdict.

    All cuts above one filled bin and up to the next have the same errors.
    """
    bins = held.groupBy(F.floor(F.least(F.greatest(F.col("score"), F.lit(-10.0)), F.lit(10.0)) / BIN).alias("bin")).agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad"))
    everything, below = W.partitionBy(), W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)  # at most 1,001 bins
    cuts = bins.select(F.greatest(F.least("bin", F.lit(0)), F.max("bin").over(below) + 1).alias("cut"),
                       F.sum("good").over(everything).alias("all_good"), F.sum("bad").over(everything).alias("all_bad"),
                       F.coalesce(F.sum("good").over(below), F.lit(0)).alias("good_below"), F.coalesce(F.sum("bad").over(below), F.lit(0)).alias("bad_below"))
    error = F.round(F.col("good_below") / F.col("all_good") - F.col("bad_below") / F.col("all_bad"), 12)
    best = cuts.filter("all_good > 0 AND all_bad > 0").orderBy(error, F.abs("cut"), "cut").select("cut").first()
    return best[0] * BIN if best else 0.0


def judge(pages: DataFrame, allow: list[str] = ALLOW, block: list[str] = BLOCK, common: int = COMMON) -> DataFrame:
    """page_id, host, path, rule, verdict and score for every row of ``pages`` (page_id, url)."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), modelled(F.col("url")).alias("text"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), allow, block)
    held_out = F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit(""))) % FOLDS == 0
    ruled = written(parts.select("*", F.monotonically_increasing_id().alias("row"), rule.alias("rule"), verdict.alias("ruled"),
                                 held_out.alias("held_out")), "url-rules")
    accepted = F.when(~F.col("held_out"), F.col("ruled") == "allow").alias("accepted")
    ratios = log_ratios(gram_counts(ruled.select("text", accepted)))
    found = scores(ruled.select("row", "text"), ratios, common)
    marked = written(ruled.drop("text").join(found, "row", "left"), "url-scores")
    cut = threshold(marked.filter("held_out AND ruled IS NOT NULL").select(F.col("ruled").alias("verdict"), "score"))
    by_model = F.when(F.col("score") >= cut, F.lit("allow")).otherwise(F.lit("block"))
    return marked.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")
