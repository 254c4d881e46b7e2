"""Benchmark decontamination: every training passage queries a BM25 index of test items.

The index holds the items; a passage is the query. Scores are divided by the score an item gives
itself, so one threshold holds for all. Equal items are one; word frequencies and lengths are those of
all items, so a score does not depend on how they are dealt into parts. Items are indexed in parts by
length and size, each by a task of its own; for a part, a text is cut into segments no shorter than its
longest item, and two neighbouring segments are a passage, so each item that a text contains lies within
one passage.

Retrieved items are verified by the share of their question's and of their answer's word shingles in
the passage. A share that suffices leaves few words out, so an item's threshold is its own score less
that of its heaviest words, as many as may be missing: nothing that could be verified is missed.

Retrieval keeps everything above the threshold. Upper bounds prune twice: the summed maxima of item
blocks rule out most passages at once (in arrays, for all segments of many texts), then a
document-at-a-time walk with pivots and block maxima scores what is left.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import digest, small_batches, stored, utf8
from gatelog.llm.near_dedup import blocks
from gatelog.llm.shingles import mixed, words

#: BM25's usual parameters.
K1, B = 1.2, 0.75
#: Items per block of the bounds; text bytes of items in one index part, and bytes of the finished parts that
#: one scan of the texts carries (both bound what is broadcast).
BLOCK, PART_BYTES, SCAN_BYTES = 8, 4 << 20, 32 << 20
#: Sums of bounds that are held at a time; copies of a word's frequency, which a frequent word's items share.
SUMS, SALTS = 1 << 21, 8
#: Least words of a segment.
SEGMENT = 64
#: Shingle words, and the share from which an item is verified.
SHINGLE, VERIFIED = 5, 0.8

_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: str | None) -> bytes:
    """Lower case, ASCII punctuation and controls as spaces."""
    return (text or "").lower().encode().translate(_PLAIN)


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's two parts: the answer is its last line, or its last sentence, or its second half."""
    for cut in (text.rstrip().rfind("\n"), max((m.start() + 1 for m in re.finditer(r"[.!?] ", text.rstrip())), default=-1)):
        if cut > 0:
            return text[:cut], text[cut:]
    half = len(text.split()) // 2
    return " ".join(text.split()[:half]), " ".join(text.split()[half:])


def _grams(hashes: np.ndarray) -> np.ndarray:
    """The distinct shingles; a shorter sequence is one shingle."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    size = min(SHINGLE, len(hashes))
    value = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        value = mixed(value, size) + hashes[k : len(hashes) - size + 1 + k]
    return np.unique(value)


@dataclass
class Index:
    """One part: postings by term in item order with impacts, and their maxima by block of items."""

    names: list
    segment: int
    terms: np.ndarray  # sorted
    begins: np.ndarray  # where each term's blocks begin
    blocks: np.ndarray  # the blocks that have the term, and the greatest impact in each
    maxima: np.ndarray
    postings: list[tuple[list[int], list[float]]]
    parts: list[tuple[np.ndarray, np.ndarray]]  # shingles of question and answer
    needed: np.ndarray  # the threshold of each block of items
    greatest: list[float] = field(init=False)
    looked_up: dict[int, dict[int, float]] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.greatest = np.maximum.reduceat(self.maxima, self.begins[:-1]).tolist() if len(self.terms) else []

    def bounds(self, term: int) -> dict[int, float]:
        """The greatest impact of a term by block; kept, and no larger than the term's list of items."""
        if term not in self.looked_up:
            own = slice(self.begins[term], self.begins[term + 1])
            self.looked_up[term] = dict(zip(self.blocks[own].tolist(), self.maxima[own].tolist(), strict=True))
        return self.looked_up[term]

    def spread(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The blocks of all terms one after another: the term's place in ``terms``, the block, the greatest impact."""
        counts = self.begins[terms + 1] - self.begins[terms]
        owner = np.repeat(np.arange(len(terms)), counts)
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - self.begins[terms], counts)
        return owner, self.blocks[at], self.maxima[at]

    @staticmethod
    def build(items: list[tuple], total: int | None = None, mean: float | None = None, known: Mapping[int, int] | None = None) -> Index:
        """Of (name, question, answer); number, mean length and word frequencies are those of these items unless given."""
        both = [words([plain(q), plain(a)]) for _, q, a in items]
        hashes = [h for h, _ in both]
        frequency = known or Counter(t for h in hashes for t in set(h.tolist()))
        total = total or len(items)
        # items with the same common words and of similar length share a block, which keeps its maxima low
        order = sorted(range(len(items)), key=lambda i: (max(((frequency[t], t) for t in hashes[i].tolist()), default=(0, 0)), len(hashes[i])))
        items, both, hashes = ([x[i] for i in order] for x in (items, both, hashes))
        mean = mean or sum(map(len, hashes)) / max(len(hashes), 1) or 1
        terms = np.array(sorted({t for h in hashes for t in h.tolist()}), np.uint64)
        place = {t: i for i, t in enumerate(terms.tolist())}
        postings: list[tuple[list[int], list[float]]] = [([], []) for _ in range(len(place))]
        parts = [(_grams(h[: b[1]]), _grams(h[b[1] :])) for h, b in both]
        thresholds = []
        for i, h in enumerate(hashes):
            impacts = {}
            for t, tf in Counter(h.tolist()).items():
                idf = math.log(1 + (total - frequency[t] + 0.5) / (frequency[t] + 0.5))
                impacts[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(h) / mean))
            own = sum(impacts.values())
            missing = sum(int(len(part) * (1 - VERIFIED) + 1e-9) for part in parts[i])
            thresholds.append(1 - sum(sorted(impacts.values(), reverse=True)[:missing]) / (own or 1))
            for t, impact in impacts.items():
                postings[place[t]][0].append(i)
                postings[place[t]][1].append(impact / own)
        begins, own_blocks, maxima = [0], [], []
        for own_items, impacts in postings:
            block = np.array(own_items) // BLOCK
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            own_blocks.append(block[starts])
            maxima.append(np.maximum.reduceat(np.array(impacts, np.float32), starts))
            begins.append(begins[-1] + len(starts))
        joined = [np.concatenate(x) if x else np.empty(0, kind) for x, kind in ((own_blocks, np.int64), (maxima, np.float32))]
        needed = np.minimum.reduceat(thresholds, np.arange(0, len(items), BLOCK)) - 1e-4  # bounds are in single precision
        return Index([n for n, _, _ in items], max([SEGMENT, *map(len, hashes)]), terms, np.array(begins), *joined, postings, parts, needed)

    def retrieve(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) with a score of at least ``threshold`` for a query of distinct terms: block-max WAND."""
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]  # item, place in the list, term
        bounds = {t: self.bounds(t) for t in terms}
        found = []
        slack = threshold - 1e-6  # bounds are kept in single precision
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, cursor in enumerate(cursors):
                total += self.greatest[cursor[2]]
                if total >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(bounds[c[2]].get(block, 0.0) for c in cursors[: pivot + 1]) < slack:
                # nothing in this block before the next list begins: go on behind both
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, item + 1)
            elif cursors[0][0] == item:
                score = sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < target:
                    own = self.postings[cursor[2]][0]
                    cursor[1] = bisect_left(own, target, cursor[1])
                    cursor[0] = own[cursor[1]] if cursor[1] < len(own) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def _hopeful(self, term: np.ndarray, starts: np.ndarray, ends: np.ndarray, after: np.ndarray) -> Iterator[int]:
        """The segments which, with the one ``after`` them, may reach an item's threshold by the bounds.

        Sums of segments and blocks are made some segments at a time, so that neither they nor the terms' blocks pile up.
        """
        n = len(self.needed)
        weight = np.cumsum((self.begins[term + 1] - self.begins[term]))[ends - 1] + n * np.arange(1, len(starts) + 1)
        k = 0
        while k < len(starts):
            limit = (weight[k - 1] if k else 0) + SUMS
            end = max(k + 1, int(np.searchsorted(weight, limit, "right")))
            more = min(end + 1, len(starts))  # the one behind the last belongs to its passage
            owner, block, most = self.spread(term[starts[k] : ends[more - 1]])
            row = np.repeat(np.arange(more - k), ends[k:more] - starts[k:more])[owner]
            sums = np.bincount(row * n + block, most, (more - k) * n).reshape(-1, n)
            together = sums[: end - k].copy()
            following = sums[1 : end - k + 1]
            together[: len(following)] += following * after[k : k + len(following), None]
            yield from (k + np.flatnonzero((together >= self.needed).any(axis=1))).tolist()
            k = end

    def matches(self, texts: list[bytes]) -> list[dict[int, tuple[float, float, float]]]:
        """For each plain text, the verified items with best score and shares."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        if not len(self.terms):
            return out
        hashes, begins = words(texts)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == hashes)
        if not len(known):
            return out
        counts = np.diff(begins)
        segments = -(-counts // self.segment)
        first = np.cumsum(segments) - segments  # each text's first segment
        owner = np.searchsorted(begins, known, "right") - 1
        segment = first[owner] + (known - begins[owner]) // self.segment
        pairs = np.unique(segment * len(self.terms) + at[known])
        segment, term = pairs // len(self.terms), pairs % len(self.terms)
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        here = segment[starts]
        text_of = np.searchsorted(first, here, "right") - 1
        after = np.append((here[1:] == here[:-1] + 1) & (text_of[1:] == text_of[:-1]), False)
        ends = np.append(starts[1:], len(segment))
        threshold = float(self.needed.min())
        for k in self._hopeful(term, starts, ends, after):
            last = k + 1 if after[k] else k
            query = np.unique(term[starts[k] : ends[last]])
            _, block, most = self.spread(query)
            if not (np.bincount(block, most, len(self.needed)) >= self.needed).any():
                continue  # the segments' common terms had been counted twice
            i = text_of[k]
            passage = None
            for item, score in self.retrieve(query.tolist(), threshold):
                if passage is None:
                    begin = begins[i] + (here[k] - first[i]) * self.segment
                    passage = _grams_of_passage(hashes[begin : min(begin + 2 * self.segment, begins[i + 1])])
                question, answer = (_share(part, passage) for part in self.parts[item])
                if question >= VERIFIED and answer >= VERIFIED:
                    known_best = out[i].get(item)
                    if known_best is None or score > known_best[0]:
                        out[i][item] = (score, question, answer)
        return out


def _grams_of_passage(hashes: np.ndarray) -> dict[int, np.ndarray]:
    """The passage's words; its shingles are made by length when asked for."""
    return {0: hashes}


def _share(part: np.ndarray, passage: dict[int, np.ndarray]) -> float:
    """The share of an item part's shingles that the passage has; a part without words is there."""
    if not len(part):
        return 1.0
    hashes = passage[0]
    best = 0.0
    for size in range(1, SHINGLE + 1) if len(part) == 1 else (SHINGLE,):
        if size not in passage and len(hashes) >= size:
            value = np.zeros(len(hashes) - size + 1, np.uint64)
            for k in range(size):
                value = mixed(value, size) + hashes[k : len(hashes) - size + 1 + k]
            passage[size] = np.unique(value)
        if size in passage:
            best = max(best, len(np.intersect1d(part, passage[size], assume_unique=True)) / len(part))
    return best


def named_items(benchmark: DataFrame, key: str = "item_id", text: str = "text", question: str | None = None, answer: str | None = None) -> DataFrame:
    """Per item that has words: name, unit (equal for equal items), q, a, n (words), terms (distinct word hashes)."""
    small_batches(benchmark.sparkSession)
    given = bool(question)
    q, a = (F.coalesce(F.col(c) if c else F.lit(None), F.lit("")) for c in (question, answer))
    source = benchmark.select(
        F.col(key).cast("string").alias("name"), F.coalesce(F.col(text) if text else F.lit(None), F.lit("")).alias("text"), q.alias("q"), a.alias("a")
    )

    @F.arrow_udf("struct<q:string,a:string,n:bigint,terms:array<bigint>>")
    def cut(texts: pa.Array, questions: pa.Array, answers: pa.Array) -> pa.Array:
        out = []
        for whole, *both in zip(texts.to_pylist(), questions.to_pylist(), answers.to_pylist(), strict=True):
            own = tuple(both) if given else question_and_answer(whole)
            hashes = words([plain(part) for part in own])[0]
            out.append({"q": own[0], "a": own[1], "n": len(hashes), "terms": np.unique(hashes).view(np.int64).tolist()})
        kind = pa.struct([("q", pa.string()), ("a", pa.string()), ("n", pa.int64()), ("terms", pa.list_(pa.int64()))])
        return pa.array(out, kind)

    parts = source.select("name", cut("text", "q", "a").alias("cut")).select("name", "cut.*")
    unit = digest(F.concat(F.length("q").cast("string").cast("binary"), F.lit(b":"), utf8(F.col("q")), utf8(F.col("a"))))
    return stored(parts.where("n > 0").select("name", unit.alias("unit"), "q", "a", "n", "terms"))


def index_parts(items: DataFrame) -> DataFrame:
    """The index of ``named_items``: part, n_bytes, index (pickled), each part of items of similar length built by a task.

    Equal items are one. Frequencies, number and mean length are over all items; a word's frequency is joined
    to the items that have it, by salt, since frequent words are in most. A part has about ``PART_BYTES`` of
    text at most, or one item that is longer.
    """
    units = stored(items.drop("name").dropDuplicates(["unit"]))
    sums = units.agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    total, mean = sums["n"], sums["mean"]
    size = F.octet_length(F.concat("q", "a")).cast("long")
    longest = F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(512)))), F.lit(9)).cast("int")
    classed = units.withColumns({"class": longest, "size": size})
    classes = classed.groupBy("class").agg(F.sum("size").alias("bytes")).collect()  # a row per power of two
    parts = F.lit(1)
    for row in classes:
        if row["bytes"] > PART_BYTES:
            parts = F.when(F.col("class") == row["class"], F.lit(-(-row["bytes"] // PART_BYTES) * 2)).otherwise(parts)
    part = F.concat_ws("-", "class", F.pmod(F.xxhash64("unit"), parts))
    dealt = classed.select(part.alias("part"), "unit", "q", "a", "terms")
    spread = dealt.select("part", "unit", F.explode("terms").alias("term"), F.pmod(F.xxhash64("unit"), F.lit(SALTS)).alias("salt"))
    frequency = spread.groupBy("term").agg(F.count("*").alias("f"))
    salted = frequency.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    weighed = spread.join(salted, ["term", "salt"]).groupBy("part", "unit")
    weighed = weighed.agg(F.sort_array(F.collect_list(F.struct("term", "f"))).alias("known"))  # an item's own words
    whole = stored(dealt.drop("terms").join(weighed.drop("part"), "unit"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("unit")
        known = {int(k["term"]) % 2**64: int(k["f"]) for own in rows["known"] for k in own}
        made = Index.build(list(zip(map(bytes, rows["unit"]), rows["q"], rows["a"], strict=True)), total, mean, known)
        packed = pickle.dumps(made, protocol=5)
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "n_bytes": [len(packed)], "index": [packed]})

    return stored(whole.groupBy("part").applyInPandas(build, "part string, n_bytes long, index binary"))


def scans(parts: DataFrame) -> Iterator[list[Index]]:
    """The parts in groups of about ``SCAN_BYTES``, one group at a time: a scan of the texts for each."""
    sizes = sorted((r["part"], r["n_bytes"]) for r in parts.select("part", "n_bytes").collect())
    group, size = [], 0
    for at, (name, own) in enumerate(sizes):
        group.append(name)
        size += own
        if at + 1 == len(sizes) or size + sizes[at + 1][1] > SCAN_BYTES:
            yield [pickle.loads(r["index"]) for r in parts.where(F.col("part").isin(group)).collect()]
            group, size = [], 0


def found_items(indexes: list[Index], spark, text: Column) -> Column:
    """Per text the verified items of some parts: array of (unit, score, question_share, answer_share)."""
    shared = spark.sparkContext.broadcast(indexes)

    @F.arrow_udf("array<struct<unit:binary,score:double,question_share:double,answer_share:double>>")
    def run(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        plains = [plain(t.as_py()) for t in texts]
        for start, end in blocks(plains):
            found: list[list[dict]] = [[] for _ in range(start, end)]
            for own in shared.value:
                for rows, matched in zip(found, own.matches(plains[start:end]), strict=True):
                    rows += [
                        {"unit": own.names[i], "score": s, "question_share": q, "answer_share": a}
                        for i, (s, q, a) in sorted(matched.items())
                    ]
            out += found
        kind = pa.struct([("unit", pa.binary()), ("score", pa.float64()), ("question_share", pa.float64()), ("answer_share", pa.float64())])
        return pa.array(out, pa.list_(kind))

    return run(text)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (doc_id, item_id) with score, question_share, answer_share: test items that a text contains.

    An item counts as contained if a passage retrieves it and has at least ``VERIFIED`` of the five-word
    shingles of its question and of its answer. Case and ASCII punctuation do not matter. Null and empty
    texts contain nothing and null items cannot be contained; repeated rows give repeated pairs; empty
    tables give no pairs. Only the named columns are read.
    """
    spark = docs.sparkSession
    kind = benchmark.schema[item].dataType
    items = named_items(benchmark, item, item_text)
    result = None
    for indexes in scans(index_parts(items)):
        own = docs.select(F.col(key).alias("doc_id"), F.explode(found_items(indexes, spark, F.col(text))).alias("m"))
        own = own.select("doc_id", "m.*")
        result = own if result is None else result.unionAll(own)
    shares = ["score", "question_share", "answer_share"]
    if result is None:
        none = docs.limit(0).select(F.col(key).alias("doc_id"), F.lit(None).cast(kind).alias("item_id"))
        return none.withColumns({c: F.lit(None).cast("double") for c in shares})
    return result.join(items.select("unit", F.col("name").cast(kind).alias("item_id")), "unit").select("doc_id", "item_id", *shares)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows whose text contains no test item, with all their columns."""
    for indexes in scans(index_parts(named_items(benchmark, item, item_text))):
        docs = docs.where(F.size(found_items(indexes, docs.sparkSession, F.col(text))) == 0)
    return docs
