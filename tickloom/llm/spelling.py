"""Spelling variants: words at one edit from each other, and the common form that a rare one stands for.

Words and their counts come from whole texts. The dictionary is a trie kept as relations, one level at a
time: ``active`` holds the words whose prefix of that level is shared with another word, ``edges`` the
letters that lead on from each shared prefix, in the form (node, letter, child). A prefix is named by the
smallest word that has it. What only one word has is a leaf that carries the word, so the trie is as deep
as the longest prefix that two words share. Each level joins the frontier of states (word, position, node,
edits) with that level's edges: a state without an edit goes on by the same letter or spends its edit on a
replaced, inserted or deleted letter; a state with one edit goes on by the same letter only; at a leaf the
rest of both words is compared. States that end in a word with one edit are neighbours.

Where two words differ by one edit, their first halves are equal or their second halves are. So there are two
tries, of the words and of the words read backwards, and in each a word may spend its edit from its middle on
only: below the middle few letters follow a prefix, where at the root all of them would.

Defined cases: null and empty texts have no words; a null id counts as an empty one; repeated rows count each
time; of several near words the most frequent one counts, then the smallest by code points; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import rolling
from tickloom.llm.tables import materialise, private, small_batches

#: Code points and occurrences that a word has at least, and how often a form is as frequent as its variant.
LEAST, OCCURRENCES, RATIO = 6, 5, 5
#: Different words that a task counts before it hands them on.
HELD = 300_000
#: Words of a level that one task handles: the deep levels have few, and need no shuffle then.
FEW = 50_000
_LETTERS = "[A-Za-zÀ-ÿ]"


def word_counts(docs: DataFrame, least: int = LEAST, planted: int | None = None) -> DataFrame:
    """word, n: runs of letters of ``least`` code points or more, with A-Z in lower case, over all texts.

    planted: where this number divides the crc32 of ``<doc_id>:<run>``, the run loses the letter at that crc32 modulo its length.
    """
    pattern = re.compile(f"{_LETTERS}{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for rows, data, bounds in rolling.chunks(batch):
                for i, a, b in zip(rows.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    # Lower case of bytes is that of A-Z alone.
                    found = pattern.findall(data[a:b].tobytes().lower().decode())
                    if planted is None:
                        held.update(found)
                        continue
                    base = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), base)
                        if h % planted == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        held[word] += n
                if len(held) >= HELD:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    texts = private(small_batches(docs), doc_id=docs["doc_id"].cast("string"), text="text")
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _letter(key: Column, at: Column) -> Column:
    """The letter at ``at`` (from 0); empty behind the end."""
    return key.substr(at + 1, F.lit(1))


def _rest(key: Column, at: Column) -> Column:
    return key.substr(at + 1, F.length(key))


def _edges(active: DataFrame, level: int) -> DataFrame:
    """way, node, letter, child, words: how many have the child; a leaf (one word) is the word itself. The letter is empty where a word ends."""
    letter = _letter(F.col("key"), F.lit(level)).alias("letter")
    return active.groupBy("way", "node", letter).agg(F.min("key").alias("child"), F.count("*").alias("words"))


def _spent(active: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """What becomes of the words that may spend their edit at this level: way, key, node, at, other (the word found, or null)."""
    states = active.filter(F.col("middle") <= level).select("way", "node", "key")
    met = states.join(edges, ["way", "node"])
    key, letter, size = F.col("key"), F.col("letter"), F.length("key")
    here, following = _letter(key, F.lit(level)), _letter(key, F.lit(level + 1))
    one = F.expr(f"levenshtein(substring(key, {level + 1}), substring(child, {level + 1}), 1)") == 1
    other, leaf = letter != here, F.col("words") == 1
    # An inserted or deleted letter that equals the next one is the same edit one letter later.
    steps = F.array(
        F.when(other & (size > level), level + 1),
        F.when(other, level),
        F.when((size > level + 1) & (following == letter) & (following != here), level + 2),
    )
    at = F.explode(F.when(leaf, F.array(F.when(one, F.lit(level)))).otherwise(steps))
    moved = met.select("way", "key", F.col("child").alias("node"), at.alias("at"), F.when(leaf, F.col("child")).alias("other"))
    return moved.filter("at is not null")


def _followed(states: DataFrame, edges: DataFrame, level: int) -> DataFrame:
    """States that have spent their edit, one letter on: way, key, node, at, other."""
    met = states.withColumn("letter", _letter(F.col("key"), F.col("at"))).join(edges, ["way", "node", "letter"])
    leaf = F.col("words") == 1
    same = _rest(F.col("key"), F.col("at")) == _rest(F.col("child"), F.lit(level))
    return met.filter(~leaf | same).select("way", "key", F.col("child").alias("node"), (F.col("at") + 1).alias("at"), F.when(leaf, F.col("child")).alias("other"))


def neighbours(words: DataFrame) -> DataFrame:
    """word, other: all pairs at one inserted, deleted or replaced code point, either way round. words: stored, distinct."""
    size = F.length("word")
    half = F.floor(size / 2)
    ahead = words.select(F.lit(0).alias("way"), F.col("word").alias("key"), half.alias("middle"))
    back = words.select(F.lit(1).alias("way"), F.reverse("word").alias("key"), (size - half).alias("middle"))
    keys = ahead.union(back)
    # Down to the least middle no edit is spent: the trie starts there.
    level = keys.agg(F.min("middle")).first()[0]
    if level is None:
        return words.select("word", F.col("word").alias("other")).limit(0)
    roots = keys.withColumn("prefix", F.col("key").substr(F.lit(1), F.lit(int(level))))
    shared = roots.groupBy("way", "prefix").agg(F.min("key").alias("node"), F.count("*").alias("words")).filter("words > 1")
    active = materialise(roots.join(shared.drop("words"), ["way", "prefix"]).select("way", "node", "key", "middle"), "trie-words")
    states, found = None, []
    while n := active.count():
        if n <= FEW:
            active = active.coalesce(1)
        edges = materialise(_edges(active, level), "trie-edges")
        moved = _spent(active, edges, level)
        if states is not None:
            moved = moved.union(_followed(states, edges, level))
        moved = materialise(moved, "frontier")
        found.append(moved.filter("other is not null").select("way", "key", "other"))
        states = moved.filter("other is null").select("way", "node", "key", "at")
        shared = edges.filter("words > 1").select("way", "node", "letter", "child")
        onward = active.withColumn("letter", _letter(F.col("key"), F.lit(level))).join(shared, ["way", "node", "letter"])
        active = materialise(onward.select("way", F.col("child").alias("node"), "key", "middle"), "trie-words")
        level += 1
    if not found:
        return words.select("word", F.col("word").alias("other")).limit(0)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    forward = [F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)).alias(name) for c, name in (("key", "word"), ("other", "other"))]
    return pairs.select(*forward).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms. Forms grow RATIO-fold each step, so a few rounds of doubling reach it."""
    roots = materialise(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialise(roots.join(on, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        roots = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return roots


def spelling_variants(counts: DataFrame, occurrences: int = OCCURRENCES, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n: of each word with at least ``occurrences``. counts: word, n."""
    words = materialise(counts.filter(F.col("n") >= occurrences), "words")
    pairs = materialise(neighbours(words.select("word")), "near-words")
    sized = pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = sized.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word",
        F.when(fits, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    forms = materialise(forms, "forms")
    return forms.join(_roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
