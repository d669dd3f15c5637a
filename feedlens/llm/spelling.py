"""Spelling variants: words of a corpus that one inserted, deleted or replaced character turns into a far more common one.

Words are the runs of ASCII and Latin-1 letters of the texts, counted inside
each task before they are shuffled. The vocabulary is cut into blocks, each of
which gets a *bit-sliced position index*: for every (position, letter) a bitset
of the block's words that have the letter there. A word is looked up by running
over its letters once and keeping three bitsets at a time, each step a few
ANDs and ORs that treat all words of the block together:

* ``exact``     words that agree so far (no error),
* ``replaced``  words that agree but for one replaced letter,
* ``longer``    words with one letter more, compared one position further on.

A word one letter shorter meets the word from its own side.

Blocks follow from the error bound: of two words one error apart, with ``c``
letters in the shorter one, either the first ``c // 2`` letters or the last
``c - c // 2`` agree. Words of ``c`` and ``c + 1`` letters therefore share a
block with those that have the same first (or last) letters, and the index is
needed for the other half only. A pair that agrees at both ends is reported by
its first letters alone. A block of over ``BLOCK`` words is cut into slices:
every word is indexed in one and looked up in all, so no block is capped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import BROADCAST_ROWS, id_text, intermediate_tables, ready, slices, work_dir, written

#: Letters of a word: ASCII and the upper part of Latin-1.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Only A to Z are made lower case.
LOWER = str.maketrans({c: chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
#: Words shorter or rarer than this are no part of the vocabulary.
MIN_LETTERS, MIN_COUNT = 6, 5
#: A form is at least so many times as common as the word.
RATIO = 5
#: One run in so many loses a letter (a known error rate to find again).
TYPO_EVERY = 199
#: Words of one index; further ones of the same block go to further slices.
BLOCK = 1 << 15
#: Counts that a task holds before it hands them on.
HELD_WORDS = 200_000


def words_of(doc_id: int | None, text: str, typo_every: int = TYPO_EVERY) -> Counter:
    """Counts of a text's lower-cased words, with the planted typing errors.

    A word's checksum over ``<doc_id>:<word>`` (no id: nothing before the colon)
    decides whether it loses a letter, and which.
    """
    counts: Counter = Counter()
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter(re.findall(LETTERS, text.translate(LOWER))).items():
        if typo_every:
            h = zlib.crc32(word.encode(), head)
            if h % typo_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
        counts[word] += n
    return counts


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
               min_count: int = MIN_COUNT, typo_every: int = TYPO_EVERY) -> DataFrame:
    """(word, n) of the words with at least ``min_letters`` letters and ``min_count`` occurrences in all texts."""
    ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              names=["word", "n"])
        for part in slices(batches):
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                for word, n in words_of(doc_id, text, typo_every).items():
                    if len(word) >= min_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    return (id_text(docs, id_col, text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def blocks(vocab: DataFrame) -> DataFrame:
    """(word, n, block): the four blocks of each word, named by class, end and shared letters."""
    def pair(shorter: Column) -> list[Column]:
        half = F.floor(shorter / 2).cast("int")
        return [F.concat(shorter.cast("string"), F.lit(FIRST), F.left("word", half)),
                F.concat(shorter.cast("string"), F.lit(LAST), F.right("word", shorter - half))]

    size = F.length("word")
    return vocab.select("word", "n", F.explode(F.array(*pair(size), *pair(size - 1))).alias("block"))


class PositionIndex:
    """Bitsets of a block's words by position and letter; bit ``j`` stands for ``members[j]``.

    Members have ``shorter`` letters or one more and agree in the first ``shared``.
    """

    def __init__(self, members: list[str], shared: int, shorter: int):
        self.members, self.shared, self.shorter = members, shared, shorter
        self.at: list[dict[str, int]] = [{} for _ in range(shorter + 2)]
        self.short = self.long = 0
        for j, word in enumerate(members):
            bit = 1 << j
            if len(word) == shorter:
                self.short |= bit
            else:
                self.long |= bit
            for place in range(shared, len(word)):
                letters = self.at[place]
                letters[word[place]] = letters.get(word[place], 0) | bit

    def near(self, word: str) -> list[int]:
        """Members that one replaced or one more letter tells apart from ``word``, which has ``shorter`` letters."""
        exact, replaced, longer = self.short | self.long, 0, 0
        for place in range(self.shared, self.shorter):
            letter = word[place]
            here = self.at[place].get(letter, 0)
            replaced = (replaced & here) | (exact & ~here)
            longer = (longer | exact) & self.at[place + 1].get(letter, 0)
            exact &= here
            if not (exact or replaced or longer):
                return []
        found, out = (replaced & self.short) | ((longer | exact) & self.long), []
        while found:
            j = found.bit_length() - 1
            found ^= 1 << j
            out.append(j)
        return out


#: Marks of blocks whose words share their first or their last letters.
FIRST, LAST = "<", ">"


def _better(old: tuple[int, int, str] | None, n: int, word: str) -> tuple[int, int, str]:
    """(number, -n, word) of the near words so far: the most common one, of equals the first."""
    return (1, -n, word) if old is None else (old[0] + 1, *min(old[1:], (-n, word)))


def near_in_block(name: str, rows: Iterator[tuple[str, int, bool]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number, -n, best) of the near words that a block's index shows.

    ``rows`` are (word, n, indexed), the indexed ones first. Those are held, the
    others pass by: words of the shorter length are looked up, and a longer one
    found is told of it, since it looks nothing up itself.
    """
    end = FIRST if FIRST in name else LAST
    shorter = int(name[:name.index(end)])
    half = shorter // 2

    def turned(word: str) -> str:
        return word if end == FIRST else word[::-1]

    held: list[tuple[str, int, bool]] = []
    index, longer = None, {}
    for row in chain(rows, [None]):
        if row is not None and row[2]:
            held.append(row)
            continue
        if index is None:
            index = PositionIndex([turned(r[0]) for r in held], half if end == FIRST else shorter - half, shorter)
            waiting = held if len(held) > 1 or row else []
        else:
            waiting = []
        for word, n, _ in chain(waiting, [row] if row else []):
            if len(word) != shorter:
                continue
            best = None
            for j in index.near(turned(word)):
                other, other_n, _ = held[j]
                if end == LAST and word[:half] == other[:half]:
                    continue  # the block of their first letters has this pair
                best = _better(best, other_n, other)
                if len(other) > shorter:
                    longer[j] = _better(longer.get(j), n, word)
            if best:
                yield word, *best
    for j, best in longer.items():
        yield held[j][0], *best


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form, form_n): how many words are one error from each word, and the most common of them.

    Of equally common ones the first in code-point order. Words without a near word have no row.
    """
    spark = vocab.sparkSession
    ready(spark)
    keyed = blocks(vocab)
    large = written(keyed.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > block),
                    f"{work_dir(spark, 'spelling')}/large-blocks")
    n_large = large.count()
    if n_large:
        large = F.broadcast(large) if n_large <= BROADCAST_ROWS else large
        keyed = keyed.join(large, "block", "left").withColumn(
            "cuts", F.coalesce(F.ceil(F.col("size") / block), F.lit(1)).cast("int")).withColumn(
            "own", F.pmod(F.xxhash64("word"), F.col("cuts")))
        keyed = keyed.select("block", "word", "n", "own", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut"))
    else:
        keyed = keyed.select("block", "word", "n", F.lit(0).alias("own"), F.lit(0).alias("cut"))
    # a large block spreads by slice; of one slice the indexed words come first
    dealt = (keyed.select("block", "cut", "word", "n", (F.col("own") == F.col("cut")).alias("indexed"))
             .repartition("block", "cut").sortWithinPartitions("block", "cut", F.col("indexed").desc()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        made = (near for (name, _), group in groupby(rows, key=lambda r: r[:2])
                for near in near_in_block(name, (r[2:] for r in group)))
        while part := list(islice(made, 10_000)):
            cols = [pa.array(c, t) for c, t in zip(zip(*part), (pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=["word", "near", "minus_n", "form"])

    found = dealt.mapInArrow(run, "word string, near long, minus_n long, form string")
    best = F.min(F.struct("minus_n", "form"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus_n")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of (word, form), by pointer doubling.

    Every form is more common than its word by a factor, so chains are short and
    end; each round halves what is left of them and starts from a written table.
    """
    folder = work_dir(forms.sparkSession, "spelling-roots")
    now, n = written(forms.select("word", F.col("form").alias("root")), f"{folder}/0"), 0
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = now.join(ahead, now["root"] == ahead["_at"], "left")
        n += 1
        after = written(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
                        f"{folder}/{n}")
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                      min_count: int = MIN_COUNT, ratio: int = RATIO, typo_every: int = TYPO_EVERY,
                      block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each word of the vocabulary.

    Two words are near if exactly one inserted, deleted or replaced code point
    tells them apart. ``form`` is the near word with the largest count (of
    equals the first in code-point order) if it is at least ``ratio`` times as
    common, else null; ``root`` is the last form of the chain, the word itself
    if there is none. With ``typo_every=0`` words are counted as they stand.

    Null and empty texts have no words; rows count as often as they occur, also
    with equal or null ids (a null id counts as an empty one); a very long text
    is one more Counter in its task; an empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    folder = work_dir(docs.sparkSession, "spelling")
    with intermediate_tables(docs.sparkSession):
        vocab = written(vocabulary(docs, id_col, text_col, min_letters, min_count, typo_every),
                        work_dir(docs.sparkSession, "vocabulary"))
        judged = vocab.join(near_words(vocab, block), "word", "left")
        follows = F.col("form_n") >= ratio * F.col("n")
        judged = written(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                       F.when(follows, F.col("form")).alias("form"),
                                       F.when(follows, F.col("form_n")).alias("form_n")), f"{folder}/judged")
        ends = written(roots(judged.where("form is not null").select("word", "form")), f"{folder}/roots")
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
