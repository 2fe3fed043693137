"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

A word list is sorted, and a query word is aligned with it entry by entry.  The rows
of the edit matrix are kept on a stack: an entry shares its first characters, so its
first rows, with the entry before it (their longest common prefix), and only the rows
beyond that are computed.  Rows are banded: with one edit allowed and the query the
shorter word, two diagonals are all that can matter.  Where both exceed one edit, all
following entries with the same prefix are skipped.

Lists are dealt out so that every pair of near words meets in exactly one of them.  Of
a pair whose shorter word has m code points, the edit lies at one place of the shorter
word (the end of the pair's common prefix).  Everything before and after an interval of
places is the same in both, so a list holds the words of one (m, interval, text before
it, text after it), each word being entered for m = its length and its length less one.
Intervals start as the two halves of a word; lists of more than ``LIST_WORDS`` words are
dealt anew with their interval halved, down to a single place, where the alphabet
bounds them (a word differs there in one letter, or in two if it is the longer one).  No list
grows with the corpus, no pair is lost, none is found twice.

Defined results: words are told apart by their code points.  Null texts have no words;
repeated rows count again; a null id counts as the empty text.  A word near no other
has 0 near words, no form, and is its own root.  Of several near words with the same
count the first in code-point order is the form.  Further columns are not read.  An
empty table has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import ascii_lower, saved

LEAST_LENGTH, LEAST_COUNT = 7, 2
FORM_RATIO = 10
LIST_WORDS = 128
SALTS = 32
OUT_ROWS = 8192


# --- words and how often they occur ------------------------------------------


def runs(documents: DataFrame) -> DataFrame:
    """(doc_id, run): every run of letters long enough to become a word, A-Z lower-cased.

    A run that loses a code point only gets shorter, so shorter runs need not leave the scan.
    """
    pattern = F.lit(rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
    found = documents.select("doc_id", F.explode(F.regexp_extract_all("text", pattern, 0)).alias("run"))
    return found.select("doc_id", ascii_lower(F.col("run")).alias("run"))


def misspelt(found: DataFrame, every: int = 31) -> DataFrame:
    """The word of each run: one in ``every`` runs, by the hash of id and run, loses a code point."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")
    hashed = found.select("run", F.crc32(F.encode(name, "UTF-8")).alias("hash"))
    at = (F.col("hash") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("hash") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame) -> DataFrame:
    """(word, n) of words that are long and frequent enough."""
    return (
        words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


# --- lists in which near words meet ------------------------------------------


def entered(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """``rows`` (word, n, m) with an interval of places, the list's key, and the word's text within."""
    end = F.length("word") - (F.col("m") - F.col("high"))
    key = F.concat_ws(
        ":", "m", "low", "high", F.substring("word", F.lit(1), F.col("low")), F.substring("word", end + 1, F.length("word"))
    )
    middle = F.substring("word", F.col("low") + 1, end - F.col("low"))
    return (
        rows.withColumns({"low": low, "high": high})
        .withColumns({"key": key, "middle": middle})
        .select("word", "n", "m", "low", "high", "key", "middle")
    )


def halved(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """Every row entered for both halves of the interval [low, high)."""
    ends = F.struct(low.alias("low"), high.alias("high"))
    cut = rows.withColumn("ends", ends).withColumn("half", F.floor((F.col("ends.low") + F.col("ends.high")) / 2).cast("int"))
    sides = F.array(
        F.struct(F.col("ends.low").alias("low"), F.col("half").alias("high")),
        F.struct(F.col("half").alias("low"), F.col("ends.high").alias("high")),
    )
    each = cut.select("word", "n", "m", F.explode(sides).alias("side"))
    return entered(each, F.col("side.low"), F.col("side.high"))


def lists(vocabulary: DataFrame, most: int = LIST_WORDS) -> DataFrame:
    """All words entered in lists of at most ``most`` words, or of one place.

    The keys of longer lists are joined with a salt, since one of them may hold a
    large part of all words.
    """
    lengths = F.array(F.length("word"), F.length("word") - 1)
    roles = vocabulary.select("word", "n", F.explode(lengths).alias("m")).filter(F.col("m") >= LEAST_LENGTH)
    level = saved(halved(roles, F.lit(0), F.col("m")), "lists")
    done = []
    while True:
        long = level.filter("high - low > 1").groupBy("key").count().filter(F.col("count") > most).select("key")
        long = saved(long, "long_lists")
        if long.isEmpty():
            return reduce(DataFrame.unionByName, [*done, level])
        salts = long.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = level.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        done.append(salted.join(salts, ["key", "salt"], "left_anti").drop("salt"))
        rest = salted.join(salts, ["key", "salt"], "left_semi").select("word", "n", "m", "low", "high")
        level = saved(halved(rest.select("word", "n", "m", F.col("low").alias("from"), F.col("high").alias("to")),
                             F.col("from"), F.col("to")), "lists")


# --- one sorted list -----------------------------------------------------------


def common_prefix(a: str, b: str) -> int:
    size = min(len(a), len(b))
    return next((k for k in range(size) if a[k] != b[k]), size)


def near_entries(query: str, entries: list[str], shared: list[int]) -> Iterator[int]:
    """Places of the entries at one edit from ``query`` that are as long, or longer by one.

    ``entries`` are sorted; ``shared`` holds the common prefix of each with the one before.
    ``skew[d]`` and ``straight[d]`` are the row of an entry's first d characters: edits to
    the query's first d - 1 and d characters.
    """
    size = len(query)
    deepest = size + 1
    padded = f"\0{query}\0"
    skew, straight = [2] * (deepest + 1), [0] * (deepest + 1)
    at, depth, count = 0, 0, len(entries)
    while at < count:
        entry = entries[at]
        length = len(entry)
        while depth < length:
            letter = entry[depth]
            before, level = skew[depth], straight[depth]
            if padded[depth] != letter:
                before += 1
            if before > level + 1:
                before = level + 1
            if padded[depth + 1] != letter:
                level += 1
            depth += 1
            skew[depth], straight[depth] = before, level
            if before > 1 and level > 1:
                break
        else:
            if (straight if length == size else skew)[length] == 1:
                yield at
        at += 1
        while at < count and shared[at] >= depth and depth and skew[depth] > 1 and straight[depth] > 1:
            at += 1
        if at < count:
            depth = min(depth, shared[at])


def near_in_list(rows: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest count among them, the first word with it) of a list's words.

    ``rows`` are (key, middle, word, n, m, high), sorted by middle.  A pair whose common prefix
    ends after the interval belongs to the next one, unless there is none.
    """
    entries = [row[1] for row in rows]
    shared = [0, *(common_prefix(a, b) for a, b in zip(entries, entries[1:]))]
    found: dict[int, list[int]] = {}
    _, _, _, _, m, high = rows[0]
    for k, row in enumerate(rows):
        if len(row[2]) > m:
            continue
        query = row[1]
        for j in near_entries(query, entries, shared):
            same_length = len(rows[j][2]) == m
            if same_length or high == m or not entries[j].startswith(query):
                found.setdefault(k, []).append(j)
                if not same_length:
                    found.setdefault(j, []).append(k)
    for k, others in found.items():
        best = min(others, key=lambda j: (-rows[j][3], rows[j][2]))
        yield rows[k][2], len(others), rows[best][3], rows[best][2]


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
FOUND_SQL = "word string, n_near bigint, best_n bigint, best string"


def near_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists come whole, one after the other, and may go on from batch to batch."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)

    held: list[tuple] = []
    for _, group in groupby(rows(), key=itemgetter(0)):
        members = list(group)
        if len(members) > 1:
            held.extend(near_in_list(members))
        if len(held) >= OUT_ROWS:
            yield batch_of(held)
            held = []
    if held:
        yield batch_of(held)


# --- near words, forms and roots ---------------------------------------------


def near_words(vocabulary: DataFrame, most: int = LIST_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of words with near words: how many, and the most frequent of them."""
    dealt = (
        lists(vocabulary, most).select("key", "middle", "word", "n", "m", "high")
        .repartition("key").sortWithinPartitions("key", "middle")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("best"))).alias("first")
    return (
        dealt.mapInArrow(near_in_lists, FOUND_SQL).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("first.order")).alias("best_n"), F.col("first.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where each word of ``forms`` (word, form) ends; every round doubles the way gone.

    A form is several times as frequent as its word, so there are no circles and few rounds.
    """
    reached = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(reached.join(onward, "root", "left"), "roots")
        reached = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.filter("next IS NOT NULL").isEmpty():
            return reached


def variant_groups(vocabulary: DataFrame, ratio: int = FORM_RATIO, most: int = LIST_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n and root for every row of ``vocabulary`` (word, n), whose words differ.

    A word's form is its most frequent near word, if that is ``ratio`` times as frequent or more.
    """
    words = saved(vocabulary.select("word", "n"), "vocabulary")
    usual = (F.col("best_n") >= ratio * F.col("n"))
    joined = words.join(near_words(words, most), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(usual, F.col("best")).alias("form"), F.when(usual, F.col("best_n")).alias("form_n"),
    )
    joined = saved(joined, "forms")
    ends = roots(joined.filter("form IS NOT NULL").select("word", "form"))
    return joined.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame) -> DataFrame:
    """The words of all documents, with their variants."""
    return variant_groups(counted(misspelt(runs(documents))))
