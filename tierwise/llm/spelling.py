"""Groups of spelling variants by pivotal bigrams.

Bigrams are ordered by the number of words that have them, rare ones first.  A word's prefix is its
first three bigrams in this order (all that are as frequent as the third, too): one edit destroys at
most two.  Two of the prefix that do not overlap, chosen by dynamic programming for the fewest
words that have them, are the word's pivots: one edit leaves at least one of them as it is.  If
two words are one edit apart, then a pivot of the one whose prefix ends first is in the prefix of
the other, and not anywhere: its place is the same and the edit comes after it, or it has moved by the
difference in length and the edit comes before it.  If the first pivot is untouched and the edit
comes after it, the words are equal up to its end; else the edit comes before the second, and they are
equal from there on.  Of what the other word has on the side of the edit, one half is as it was,
too.  Pivots are joined with prefixes on just that, and the edit distance verifies what is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import map_slices, written, written_to
from tierwise.scratch import delete, work_dir

#: Letters of a run; at most 26 + 64 of them are left when A-Z are in lower case, so there are at most 8,100 bigrams.
RUN = "[A-Za-zÀ-ÿ]+"
#: One edit: a prefix has one bigram more than it can destroy, and of the pivots one survives.
EDITS, GRAM = 1, 2
PREFIX, PIVOTS = GRAM * EDITS + 1, EDITS + 1
#: Of the occurrences of runs, one in so many loses a letter.
LOSES = 31


def words_of(docs: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n): the runs of letters of all texts; those whose checksum says so lose a letter."""
    run = F.explode(F.regexp_extract_all(F.col("text"), F.lit(RUN), F.lit(0)))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), run.alias("run")).select("doc_id", low.alias("run"))
    h = F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary"))
    rows = rows.select("run", h.alias("h")).withColumn("at", F.expr("int(h % length(run))"))
    word = F.when(F.col("h") % LOSES == 0, F.expr("concat(left(run, at), substr(run, at + 2))")).otherwise(F.col("run"))
    counted = rows.select(word.alias("word")).filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def grams(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - GRAM + 1), lambda i: F.substring(word, i, F.lit(GRAM)))


def prefix_of(ranks: list[int]) -> list[int]:
    """Places of the bigrams that are as rare as the ``PREFIX``-th, or rarer, in their order in the word."""
    last = sorted(ranks)[PREFIX - 1]
    return [at for at, rank in enumerate(ranks) if rank <= last]


def pivots_of(places: list[int], costs: list[int]) -> list[int]:
    """``PIVOTS`` of the places, ascending, no two of which overlap, of the least total cost.

    ``best[k]`` is the least cost of k places that end before the next one may begin.
    """
    none = (float("inf"), ())
    best: list[list[tuple]] = [[(0, ())] + [none] * PIVOTS]  # by the number of places looked at
    for i, (at, cost) in enumerate(zip(places, costs, strict=True)):
        free = next(j for j in range(i, -1, -1) if j == 0 or places[j - 1] + GRAM <= at)
        row = [(0, ())]
        for k in range(1, PIVOTS + 1):
            before, chosen = best[free][k - 1]
            row.append(min(best[i][k], (before + cost, (*chosen, at))))
        best.append(row)
    return list(best[-1][PIVOTS][1])


def prefixes(words: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """(word, n, last, places, first, second): the rank of the prefix's last bigram, the places of the prefix
    and of its two pivots."""
    order = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}
    shared = words.sparkSession.sparkContext.broadcast((order, frequency))

    def handle(rows: dict[str, list]) -> dict[str, list]:
        ranks_of, costs_of = shared.value
        out: dict[str, list] = {"word": rows["word"], "n": rows["n"], "last": [], "places": [], "first": [], "second": []}
        for word in rows["word"]:
            found = [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]
            ranks = [ranks_of[g] for g in found]
            places = prefix_of(ranks)
            first, second = pivots_of(places, [costs_of[found[at]] for at in places])
            for name, value in (("last", max(ranks[at] for at in places)), ("places", places), ("first", first), ("second", second)):
                out[name].append(value)
        return out

    return map_slices(words, lambda: handle, "word string, n long, last int, places array<int>, first int, second int")


def edited_after(at: str, rest: str) -> list[Column]:
    """Keys of a word that is as it was up to the bigram at ``at``; the other word has ``rest`` code points behind
    it, the first half of which, or else the second, ``word`` has too."""
    second = f"({rest}) - ({rest}) div 2"
    return [
        F.expr(f"if({rest} < 0, null, xxhash64('<', {rest}, left(word, {at} + {GRAM} + ({rest}) div 2)))"),
        F.expr(
            f"if({rest} < 0 OR {second} > length(word) - {at} - {GRAM}, null, "
            f"xxhash64('<', {rest}, left(word, {at} + {GRAM}), right(word, {second})))"
        ),
    ]


def edited_before(at: str, rest: str) -> list[Column]:
    """Likewise, of a word that is as it was from the bigram at ``at`` on; the other one has ``rest`` before it."""
    second = f"({rest}) - ({rest}) div 2"
    return [
        F.expr(f"if({rest} < 0, null, xxhash64('>', {rest}, left(word, ({rest}) div 2), substr(word, {at} + 1)))"),
        F.expr(f"if({rest} < 0 OR {second} > {at}, null, xxhash64('>', {rest}, substr(word, {at} + 1 - ({second}))))"),
    ]


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all words one inserted, deleted or replaced code point apart, both ways."""
    counts = words.select(F.explode(grams(F.col("word"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    frequency = {r.gram: r.n for r in counts.collect()}  # at most 8,100
    found = written(prefixes(words, frequency), "prefixes")
    placed = found.select("word", "n", "last", F.explode("places").alias("at"))
    keys = [*edited_after("at", f"length(word) - at - {GRAM}"), *edited_before("at", "at")]
    index = placed.select(F.explode(F.array(*keys)).alias("key"), "word", "n", "last")
    moved = found.select("word", "n", "last", "first", "second", F.explode(F.array(*map(F.lit, (-EDITS, 0, EDITS)))).alias("by"))
    keys = [*edited_after("first", f"length(word) - first - {GRAM} + by"), *edited_before("second", "second + by")]
    probes = moved.select(F.explode(F.array(*keys)).alias("key"), "word", "n", "last").filter("key IS NOT NULL")

    a = probes.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("last").alias("a_last"))
    b = index.select(F.col("key").alias("b_key"), F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("last").alias("b_last"))
    close = "a <> b AND a_last <= b_last AND abs(length(a) - length(b)) <= 1 AND levenshtein(a, b, 1) = 1"
    near = a.join(b, (F.col("key") == F.col("b_key")) & F.expr(close))
    both = F.explode(F.expr("array(struct(a AS word, b AS near, b_n AS near_n), struct(b AS word, a AS near, a_n AS near_n))"))
    return near.select(both.alias("l")).select("l.*").distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms that begins at each word that has one.

    Chains are halved each round; they are short, since each form occurs a multiple as often.
    """
    spark, moved = forms.sparkSession, 1
    place = work_dir(spark, "roots")
    now = written_to(forms.select("word", F.col("form").alias("root")), place)
    while moved:
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        after = now.select("word", "root").join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        spent, place = place, work_dir(spark, "roots")
        now = written_to(after, place)
        moved = now.filter("further IS NOT NULL").count()
        delete(spark, spent)
    return now.select("word", "root")


def variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``docs`` (doc_id, text).

    Words are the runs of letters of all texts (A-Z in lower case) with at least ``least_length`` code points
    and ``least_count`` occurrences; those occurrences whose checksum of id and run ``LOSES`` divides
    lose one letter beforehand.  A word's form is the most frequent of its near words (ties: the first in
    code-point order), if it is at least ``ratio`` times as frequent; the root is the last one that forms
    lead to, the word itself if it has none.  Null and empty texts have no words; an id that is null
    counts as the empty text, and repeated rows count each; other columns are not read.
    """
    if least_length <= PREFIX or ratio <= 1:
        raise ValueError(f"words need more than {PREFIX} code points, and forms to be more frequent")
    words = written(words_of(docs, least_length, least_count), "words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("most")
    )
    form = F.when(-F.col("most.minus") >= F.lit(ratio) * F.col("n"), F.struct(F.col("most.near").alias("form"), (-F.col("most.minus")).alias("n")))
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("f"))
    judged = written(judged.select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n")), "forms")
    root = roots_of(judged.filter("form IS NOT NULL"))
    return judged.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
