"""Main text of web pages, by wrappers inferred from the pages of a host.

A wrapper is a regular expression without unions over tags and text: elements in order, each of them once,
optional, repeated, or both, groups of elements that repeat together, and places of text that are constant
or a slot. It is inferred by alignment. A page's token stream is aligned with itself first, which turns
like neighbours into repeated groups; then with the wrapper so far. Where texts differ, the place becomes a slot; where
tags differ, what one side has more of becomes a repeated group if it repeats what precedes it, else
the shorter stretch up to the next common tag becomes optional.

Pages of a host are dealt into buckets by their streams, each bucket gives one wrapper, and wrappers are
aligned with each other in rounds until a host has one, so a host with a third of all pages is no task of
its own. The order is that of the streams, so results do not depend on how the pages are dealt. Streams hold
hashes of texts, not texts.

Each page is then read again along its host's wrapper. Main regions are told by the wrapper's elements, and
where a page has none, text that the wrapper has as constant, and repeated links, are left out as well.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import stored
from gatelog.llm.html_blocks import HARD, HEAD, SOFT, Node, read

#: Wrappers aligned in one go; streams a constant text must occur in; like neighbours that make a group at most.
FAN, LEAST_PAGES, PERIOD = 64, 3, 3
#: Share of a repeated block's characters inside links that makes it a menu.
LINKS = 0.8
#: Elements of one level beyond which labels are reduced to roles and tags.
WIDTH = 256
OPTIONAL, REPEATED = 1, 2
TEXT, GROUP = "#", "("


# A text place is [TEXT, quantifier, pages, characters, characters in links, hash or None],
# an element [label, quantifier, children], a group [GROUP, quantifier, children].


def name(item: list) -> str:
    """What must be equal for two items to be aligned."""
    return GROUP + "\0".join(map(name, item[2])) if item[0] == GROUP else item[0]


def stream(node: Node) -> list:
    """A page's own expression: its elements with repeats folded."""
    items = []
    for child in node.children:
        if isinstance(child, tuple):
            block, linked = child
            items.append([TEXT, 0, 1, len(block), linked, xxhash.xxh64_intdigest(block) >> 16])
        else:
            items.append([child.label, 0, stream(child)])
    return narrow(fold(items))


def joined(a: list, b: list, within: bool) -> list:
    """One item for two of the same name; ``within`` a page, or of two sets of pages."""
    if a[0] == TEXT:
        constant = a[5] if a[5] == b[5] and not within else None
        return [TEXT, a[1] | b[1], max(a[2], b[2]) if within else a[2] + b[2], a[3] + b[3], a[4] + b[4], constant]
    return [a[0], a[1] | b[1], align(a[2], b[2], within)]


def marked(item: list, quantifier: int) -> list:
    return [item[0], item[1] | quantifier, *item[2:]]


def fold(items: list) -> list:
    """Neighbours that repeat become one repeated item, or a repeated group of up to ``PERIOD``."""
    for period in range(1, PERIOD + 1):
        names = [name(item) for item in items]
        if len(items) < 2 * period or len(set(names)) == len(names):
            break
        out, at = [], 0
        while at < len(items):
            unit, end = names[at : at + period], at + period
            while end + period <= len(items) and names[end : end + period] == unit:
                end += period
            if end == at + period or (period > 1 and any(items[i][0] == GROUP for i in range(at, at + period))):
                out.append(items[at])
                at += 1
                continue
            first = items[at : at + period]
            for other in range(at + period, end, period):
                first = [joined(a, b, True) for a, b in zip(first, items[other : other + period], strict=True)]
            out.append(marked(first[0], REPEATED) if period == 1 else [GROUP, REPEATED, first])
            at = end
        items = out
    return items


def grouped(items: list, groups: list[list]) -> list:
    """Stretches of items that match a group of the other side, as such groups."""
    for group in groups:
        inner = [name(i) for i in group[2]]
        names, out, at = [name(i) for i in items], [], 0
        while at < len(items):
            if names[at : at + len(inner)] == inner:
                out.append([GROUP, 0, items[at : at + len(inner)]])
                at += len(inner)
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def align(a: list, b: list, within: bool = False) -> list:
    """One expression for two: equal names are joined, the rest is optional; the cost is linear."""
    groups_a, groups_b = ([i for i in side if i[0] == GROUP] for side in (a, b))
    if groups_a or groups_b:
        a, b = fold_groups(grouped(a, groups_b)), fold_groups(grouped(b, groups_a))
    names_a, names_b = [name(i) for i in a], [name(i) for i in b]
    if names_a == names_b:
        return [joined(x, y, within) for x, y in zip(a, b, strict=True)]
    next_a, next_b = _places(names_a), _places(names_b)
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if names_a[i] == names_b[j]:
            out.append(joined(a[i], b[j], within))
            i, j = i + 1, j + 1
            continue
        there, here = _next(next_a, names_b[j], i), _next(next_b, names_a[i], j)
        if there is not None and (here is None or there - i <= here - j):
            out.extend(marked(x, OPTIONAL) for x in a[i:there])
            i = there
        elif here is not None:
            out.extend(marked(x, OPTIONAL) for x in b[j:here])
            j = here
        else:
            out.extend((marked(a[i], OPTIONAL), marked(b[j], OPTIONAL)))
            i, j = i + 1, j + 1
    out.extend(marked(x, OPTIONAL) for x in a[i:] + b[j:])
    return narrow(fold(out))


def fold_groups(items: list) -> list:
    """Neighbouring groups of the same items as one."""
    out: list = []
    for item in items:
        if out and item[0] == GROUP and out[-1][0] == GROUP and name(out[-1]) == name(item):
            out[-1] = marked(joined(out[-1], item, True), REPEATED)
        else:
            out.append(item)
    return out


def _places(names: list[str]) -> dict[str, list[int]]:
    places: dict[str, list[int]] = {}
    for at in range(len(names) - 1, -1, -1):
        places.setdefault(names[at], []).append(at)
    return places


def _next(places: dict[str, list[int]], wanted: str, at: int) -> int | None:
    """The next place of the name, if any; those passed are dropped."""
    own = places.get(wanted)
    while own and own[-1] < at:
        own.pop()
    return own[-1] if own else None


def short(own: str) -> str:
    """A label without class tokens."""
    return own[0] + own[1:].split(" ")[0]


def narrow(items: list) -> list:
    """A level of very many elements with labels of role and tag only, so that a wrapper stays small."""
    if len(items) <= WIDTH:
        return items
    plain: dict[str, list] = {}
    for item in items:
        for own in item[2] if item[0] == GROUP else [item]:
            own = [short(own[0]), own[1] | REPEATED | OPTIONAL, *own[2:]]
            plain[own[0]] = joined(plain[own[0]], own, True) if own[0] in plain else own
    return list(plain.values())


def host(url: Column) -> Column:
    """A URL's host in lower case, without port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def streams(pages: DataFrame) -> DataFrame:
    """The distinct streams of each host, from (host, html): host, body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = {(own, json.dumps(stream(read(page)), separators=(",", ":"))) for own, page in pairs}
            columns = [pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["host", "body"])

    return pages.mapInArrow(run, "host string, body string").distinct()


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, bucket, body) in order: one wrapper for each bucket, at most one in memory."""
    own, wrapper = None, None
    for batch in batches:
        done = []
        for *key, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            items = json.loads(body)
            if key != own:
                if own:
                    done.append((*own, wrapper))
                own, wrapper = key, items
            else:
                wrapper = align(wrapper, items)
        if done:
            yield _rows(done)
    if own:
        yield _rows([(*own, wrapper)])


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64())
    columns = [pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)]
    bodies = pa.array([json.dumps(d[2], separators=(",", ":")) for d in done], pa.string())
    return pa.RecordBatch.from_arrays([*columns, bodies], ["host", "bucket", "body"])


def wrappers(pages: DataFrame) -> DataFrame:
    """Each host's wrapper, from (host, html): host, wrapper (JSON)."""
    left = stored(streams(pages).withColumn("bucket", F.xxhash64("body")))
    buckets = -(-left.count() // FAN)
    while True:
        dealt = left.withColumn("bucket", F.pmod("bucket", F.lit(max(1, buckets))))
        ordered = dealt.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "body")
        left = stored(ordered.select("host", "bucket", "body").mapInArrow(_aligned, "host string, bucket long, body string"))
        if buckets <= 1:
            return left.select("host", F.col("body").alias("wrapper"))
        buckets = -(-buckets // FAN)


class Wrapper:
    """A wrapper to read pages by."""

    def __init__(self, items: list):
        self.items, self.half = items, 0.0
        # constants tell boilerplate only where other text of the same pages varies
        self.constants = any(self._varies(i, False) for i in items)

    def _varies(self, item: list, inside: bool) -> bool:
        if item[0] == TEXT:
            return not inside and item[5] is None
        inside = inside or item[0][0] in (HARD, SOFT, HEAD)
        return any(self._varies(i, inside) for i in item[2])

    def boilerplate(self, item: list | None, repeated: bool) -> bool:
        """Whether a place of text outside a sure main region is part of the template."""
        if item is None:
            return False
        _, quantifier, pages, characters, linked, constant = item
        if constant is not None:
            return self.constants and pages >= LEAST_PAGES
        return (repeated or bool(quantifier & REPEATED)) and linked > LINKS * characters

    def matched(self, children: list, items: list) -> Iterator[tuple[object, list | None, bool]]:
        """Each child of an element with its place in the wrapper, and whether that is in a repeated group."""
        flat = []
        for item in items:
            flat.extend((i, True) for i in item[2]) if item[0] == GROUP else flat.append((item, bool(item[1] & REPEATED)))
        at_of: dict[str, list[int]] = {}
        for at, (item, _) in enumerate(flat):
            at_of.setdefault(item[0], []).append(at)
        at = 0
        for child in children:
            own = TEXT if isinstance(child, tuple) else child.label
            places = at_of.get(own) or at_of.get(short(own))
            if not places:
                yield child, None, False
                continue
            later = [p for p in places if p >= at] if len(places) > 1 else places
            at = later[0] if later else places[0]
            yield child, *flat[at]
            if not flat[at][1]:
                at += 1

    def main_text(self, page: Node) -> list[str]:
        """The blocks of the main text, in order."""
        blocks: list[tuple[str, set[str], bool]] = []
        self.half = size(page) / 2
        self._walk(page, self.items, frozenset(), False, blocks)
        for rank in "12":
            found = [text for text, ranks, _ in blocks if rank in ranks]
            if found:
                return found
        blocks = [b for b in blocks if not b[2]]
        return [text for text, ranks, _ in blocks if "3" in ranks] or [text for text, _, _ in blocks]

    def _walk(self, node: Node, items: list, ranks: frozenset, repeated: bool, blocks: list) -> None:
        for child, item, again in self.matched(node.children, items):
            if isinstance(child, tuple):
                blocks.append((child[0], ranks, self.boilerplate(item, repeated or again)))
                continue
            role = child.label[0]
            if role == HARD or (role == SOFT or role == HEAD and not ranks) and not self._rescued(child):
                continue
            own = ranks | {role} if role in "123" else ranks
            self._walk(child, item[2] if item else [], own, repeated or again, blocks)


    def _rescued(self, node: Node) -> bool:
        """Whether an element that looks like boilerplate is a frame around the main text.

        An article is inside, or a lesser main region and more than half of the page's text.
        """
        return holds(node, "12") or (holds(node, "3") and size(node) > self.half)


def holds(node: Node, ranks: str) -> bool:
    """Whether a main region of these ranks with text is inside, outside boilerplate."""
    todo = list(node.children)
    while todo:
        child = todo.pop()
        if isinstance(child, Node) and child.label[0] != HARD:
            if child.label[0] in ranks and size(child):
                return True
            todo.extend(child.children)
    return False


def size(node: Node) -> int:
    """Characters of text outside sure boilerplate."""
    todo, total = [node], 0
    while todo:
        own = todo.pop()
        if isinstance(own, tuple):
            total += len(own[0])
        elif own.label[0] != HARD:
            todo.extend(own.children)
    return total


@lru_cache(maxsize=64)
def _known(wrapper: str) -> Wrapper:
    return Wrapper(json.loads(wrapper))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    ``text`` is the main text: blocks in page order joined by one line end, character references decoded,
    white space (Unicode's) inside a block turned into one space, br counted as white space. It is empty if there is
    none; a null page is empty. Rows without a URL, or with one that names no host, share a wrapper. Repeated rows
    each have a result, and count once in the wrapper, as do pages with the same stream. An empty table gives no rows.
    Other columns are not read.
    """
    source = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    named = source.withColumn("host", host(F.col("url")))
    known = wrappers(named.select("host", "html")).select(F.col("host").alias("own"), "wrapper")
    joined_rows = named.join(known, F.col("host") == F.col("own"), "left").select("page_id", "url", "html", "wrapper")
    kinds = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            texts = ["\n".join(_known(wrapper or "[]").main_text(read(page))) for page, wrapper in rows]
            columns = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["page_id", "url", "text", "n_chars"])

    return joined_rows.mapInArrow(run, f"{kinds}, text string, n_chars long")
