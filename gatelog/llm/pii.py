"""Personal data: patterns, and terms that give a protected entity away.

Base spans (email, ip, card, phone) come from patterns. Each distinct base value is a protected entity.
From the corpus, the information a term t (a word of three letters or more) carries about the entity e is

    I(t, e) = log(c(t, e) · N / (d(t) · d(e))),  with at most H(e) = log(N / d(e)) to give away,

where N counts distinct texts, d texts with the term or the entity, and c the distinct texts in which
they occur together, wherever in the text: copies of a text count once everywhere, so they are no
evidence for a term and none against it. A term is generalised from ``GENERALISED`` of H(e) and removed
from ``REMOVED``; it needs ``LEAST_CONTEXTS`` texts. Its occurrences are marked in all texts, also in
those without the entity.

A term is generalised to a class of the corpus: the terms that begin with the same letters. A class k is
in at least as many texts as its most frequent term, d(k), and meets e at most d(e) times, so it cannot
tell more than log(N / d(k)) of e. The longest beginning (of ``CLASS`` letters) whose bound is below
``GENERALISED`` of H(e) stands for the term, as ``qui*``, for every e that the term tells; where there
is none, the word ``term`` in brackets does.

All of it is DataFrame functions. Patterns are written so that Java's matcher neither recurses nor
backtracks over long runs: inner separators are first replaced by a private-use character of the same
length, which turns repeated groups into character classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelog.llm.common import digest, likely, likely_marks, stored, utf8, whole

#: Span kinds in their order; the last is added by the method.
KINDS = ("email", "ip", "card", "phone", "term")
#: Shares of an entity's information; least texts of a term and an entity; parts of a text placed at a time.
GENERALISED, REMOVED, LEAST_CONTEXTS, PLACED = 0.8, 0.95, 2, 32
#: Letters of a class; code points of a piece of text that is looked into by place; code points of a zone in which spans meet.
CLASS, PIECE, ZONE = (3, 8), 256, 256

_JOIN, _OTHER = "\ue000", "\ue001"
_LOCAL = r"[A-Za-z0-9._%+\x{E000}-]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\x{{E000}}[A-Za-z0-9\x{{E000}}-]*+"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_CARD = r"[0-9][0-9\x{E000}]{11,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_SPAN = "struct<kind:int,start:int,end:int,value:string>"


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once: an array of one element binds it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, join) -> Column:
    """For an array of integers: ``join`` (a sum or a maximum) of those before each, from 0 on, and of all at the end.

    Blocks as wide as the cube root keep the copying of growing arrays near the length of the array.
    """
    blank = F.array().cast("array<int>")

    def scanned(items, own):
        begin = F.struct(F.lit(0).alias("at"), blank.alias("all"))
        return F.aggregate(
            items, begin, lambda s, x: F.struct(join(s["at"], own(x)).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all"))
        )

    def all_blocks(array):
        width = F.ceil(F.cbrt(2.0 * F.size(array))).cast("int")
        numbers = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / width).cast("int"))
        return F.transform(numbers, lambda i: scanned(F.slice(array, i * width + 1, width), lambda x: x))

    def shifted(blocks):
        def put(outer):
            moved = F.zip_with(blocks, outer["all"], lambda block, at: F.transform(block["all"], lambda x: join(x, at)))
            return F.concat(F.flatten(moved), F.array(outer["at"]))

        return _bound(scanned(blocks, lambda block: block["at"]), put)

    return _bound(values, lambda array: F.when(F.size(array) > 0, _bound(all_blocks(array), shifted)).otherwise(F.array(F.lit(0))))


def _sums(lengths: Column) -> Column:
    return _before(lengths, lambda a, b: a + b)


def _located(text: Column, pattern: str, kind: int) -> Column:
    """Matches with their places in code points: what is between them, and they, add up to the text."""
    blank = F.array().cast(f"array<{_SPAN}>")

    def placed(pairs):
        starts = _sums(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["value"])))

        def span(pair, at):
            start = at + F.length(pair["gap"])
            end = start + F.length(pair["value"])
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["value"].alias("value"))

        return F.zip_with(pairs, F.slice(starts, F.lit(1), F.size(pairs)), span)

    def matched(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        return F.when(F.size(found) > 0, _bound(pairs, placed)).otherwise(blank)

    return _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), matched)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum must end in zero."""
    n = F.length(digits)
    places = F.sequence(F.lit(1), n)
    total = F.aggregate(
        places,
        F.lit(0),
        lambda s, i: s
        + F.when(
            (n - i) % 2 == 1,
            F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """All base spans of a text in order: array of kind (its number), start, end (code points), value."""
    blank = F.array().cast(f"array<{_SPAN}>")
    own = F.replace(text, F.lit(_JOIN), F.lit(_OTHER))
    labels = F.regexp_replace(own, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _JOIN)
    joined = F.regexp_replace(own, r"(?<=[0-9])[\x20-](?=[0-9])", _JOIN)
    email = F.when(F.contains(text, F.lit("@")), _located(labels, _EMAIL, 0)).otherwise(blank)
    numbers = text.rlike("[0-9]")
    ip = F.filter(_located(own, _IP, 1), lambda s: s["value"].rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"))
    card = F.filter(_located(joined, _CARD, 2), lambda s: F.length(_digits(s["value"])).between(12, 19))
    card = F.filter(card, lambda s: _luhn(_digits(s["value"])))
    phone = F.filter(_located(own, _PHONE, 3), lambda s: F.length(_digits(s["value"])).between(9, 15))
    phone = F.when(F.contains(text, F.lit("+")), phone).otherwise(blank)
    numbered = F.when(numbers, F.concat(ip, card, phone)).otherwise(blank)
    return F.array_sort(
        F.concat(email, numbered),
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]),
    )


def _entity(span: Column) -> Column:
    """A span's value without the ways of writing it."""
    value = F.when(span["kind"] == 0, F.lower(F.replace(span["value"], F.lit(_JOIN), F.lit("."))))
    value = value.when(span["kind"] == 1, span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"].cast("string"), F.lit(":"), value)


def _parts(text: Column) -> Column:
    """What is between characters that are no letters."""
    return F.split(text, r"[^\p{L}]", -1)


def _vocabulary(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.filter(_parts(text), lambda w: F.length(w) >= 3), F.lower))


def _contexts(text: Column, spans: Column) -> Column:
    """A text's name, its distinct entities, and its distinct terms if it has entities."""
    entities = F.array_distinct(F.transform(spans, _entity))
    terms = F.when(F.size(spans) > 0, _vocabulary(text)).otherwise(F.array().cast("array<string>"))
    return F.struct(digest(utf8(text)).alias("name"), entities.alias("entities"), terms.alias("terms"))


def _blocks(text: Column) -> Column:
    """The parts of a text in blocks, with the place of each block's first part: array of at, parts."""

    def blocks(parts):
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / PLACED).cast("int"))
        return F.transform(numbers, lambda i: F.slice(parts, i * PLACED + 1, PLACED))

    def placed(cut):
        sizes = F.transform(cut, lambda block: F.aggregate(block, F.lit(0), lambda n, part: n + F.length(part) + 1))
        starts = F.slice(_sums(sizes), F.lit(1), F.size(cut))
        return F.zip_with(cut, starts, lambda parts, at: F.struct(at.alias("at"), parts.alias("parts")))

    return _bound(_parts(text), lambda parts: _bound(blocks(parts), placed))


def _places(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, term, start, end) of all terms of the texts (row, text) that are in ``wanted`` (term).

    Words of a text are rows before they are placed; only a likely term's place is counted out in its block.
    """
    blocks = texts.select("row", F.explode(_blocks(F.col("text"))).alias("block"))
    parts = blocks.select("row", F.col("block.at").alias("at"), F.col("block.parts").alias("parts"))
    words = parts.select("row", "at", "parts", F.posexplode("parts").alias("place", "part")).where(F.length("part") >= 3)
    hits = likely(words.withColumn("term", F.lower("part")), "term", wanted)
    start = F.col("at") + F.aggregate(F.slice("parts", F.lit(1), F.col("place")), F.lit(0), lambda n, part: n + F.length(part) + 1)
    return hits.select("row", "term", start.alias("start"), (start + F.length("part")).alias("end")).join(wanted, "term")


def vocabulary(texts: DataFrame, text: str = "text") -> DataFrame:
    """(term, d_term): every term with the number of rows that hold it, stored."""
    terms = texts.select(F.explode(_vocabulary(F.coalesce(F.col(text), F.lit("")))).alias("term"))
    return stored(terms.groupBy("term").agg(F.count("*").alias("d_term")))


def disclosures(found: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(entity, term, share, d_entity) of the pairs whose share of the entity's information reaches the threshold.

    ``found`` has the contexts of distinct texts, ``counts`` their ``vocabulary``, ``total`` their number.
    Every count is combined before its shuffle. As c is at most d(e), a share needs a term of at most
    d(e) · (N / d(e)) ** (1 - GENERALISED) texts, and of LEAST_CONTEXTS at least, as does the entity: pairs are
    made only of those, so frequent terms and entities of one text, which cannot be told, make none.
    """
    n = F.lit(float(max(total, 1)))
    own = found.where(F.size("contexts.entities") > 0).select("row", "contexts.*")
    listed = own.select("row", "name", F.explode("entities").alias("entity"))
    entities = listed.groupBy("entity").agg(F.count("*").alias("d_entity")).where(F.col("d_entity") >= LEAST_CONTEXTS)
    entities = stored(entities.where(F.col("d_entity") < n))
    most = F.col("d_entity") * F.pow(n / F.col("d_entity"), F.lit(1 - GENERALISED)) * (1 + 1e-9)
    limit = entities.agg(F.max(most)).first()[0] or 0.0
    terms = counts.where(F.col("d_term").between(F.lit(LEAST_CONTEXTS), F.lit(limit)))
    # equal texts are one: the first row of a name stands for it
    firsts = own.groupBy("name").agg(F.min("row").alias("row"))
    telling = stored(listed.join(firsts, ["name", "row"]).join(entities, "entity").select("row", "entity", "d_entity", most.alias("most")))
    with_entity = likely(own.select("row", "terms"), "row", telling)
    words = likely(with_entity.select("row", F.explode("terms").alias("term")), "term", terms)
    met = stored(words.join(terms, "term").select("row", "term", "d_term"))
    pairs = met.join(telling, "row").where(F.col("d_term") <= F.col("most"))
    told = pairs.groupBy("entity", "term").agg(F.count("*").alias("c"), F.first("d_term").alias("d_term"), F.first("d_entity").alias("d_entity"))
    information = F.log(F.col("c") * n / (F.col("d_term") * F.col("d_entity")))
    share = information / F.log(n / F.col("d_entity"))
    told = told.where(F.col("c") >= LEAST_CONTEXTS).select("entity", "term", share.alias("share"), "d_entity")
    return told.where(F.col("share") >= GENERALISED)


def classes(shares: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(term, class): the class of each term of ``shares`` (term, d_entity: the most of the entities it tells) that has one."""
    n = F.lit(float(max(total, 1)))

    def beginnings(term):
        lengths = F.sequence(F.lit(CLASS[0]), F.least(F.lit(CLASS[1]), F.length(term)))
        return F.explode(F.transform(lengths, lambda k: F.substring(term, F.lit(1), k)))

    wanted = stored(shares.select("term", "d_entity", beginnings(F.col("term")).alias("class")))
    known = likely(counts.select("d_term", beginnings(F.col("term")).alias("class")), "class", wanted)
    sizes = known.groupBy("class").agg(F.max("d_term").alias("d_class"))
    hidden = F.log(n / F.col("d_class")) < GENERALISED * F.log(n / F.col("d_entity"))
    return wanted.join(sizes, "class").where(hidden).groupBy("term").agg(F.max_by("class", F.length("class")).alias("class"))


def _distinct(source: DataFrame) -> tuple[DataFrame, int]:
    """The distinct texts (row, text) of ``source`` (text_key, text) and their number.

    Only texts that likely have copies are shuffled and stored; the others are read where they are.
    """
    copies = stored(source.groupBy("text_key").agg(F.count("*").alias("n")))
    rows = source.select(F.col("text_key").alias("row"), "text")
    marked = likely_marks(rows, "row", copies.where("n > 1").select(F.col("text_key").alias("row")), "copied")
    repeated = stored(marked.where("copied").select("row", "text").dropDuplicates(["row"]))
    return marked.where("NOT copied").select("row", "text").unionByName(repeated), copies.count()


def _found(texts: DataFrame, total: int) -> DataFrame:
    """(row, base, added) of distinct texts, stored."""
    spans = texts.select("row", "text", base_spans(F.col("text")).alias("base"))
    found = stored(spans.select("row", "base", _contexts(F.col("text"), F.col("base")).alias("contexts")))
    counts = vocabulary(texts)
    shares = disclosures(found, counts, total).groupBy("term").agg(F.max("share").alias("share"), F.max("d_entity").alias("d_entity"))
    # one row per term on one side; the other side's hot terms are split by the engine
    shares = stored(shares)
    broader = classes(shares.where(F.col("share") < REMOVED), counts, total)
    value = F.when(F.col("share") >= REMOVED, "removed").otherwise(F.coalesce(F.concat("class", F.lit("*")), F.lit("[term]")))
    marks = stored(shares.join(broader, "term", "left").select("term", value.alias("value")))
    hits = stored(_places(texts, marks))

    # a base span keeps its place; words that meet one are not added again. Zones spread the spans of a long text
    def zoned(df):
        zones = F.sequence(F.floor(F.col("start") / ZONE), F.floor((F.col("end") - 1) / ZONE))
        return df.withColumn("zone", F.explode(zones))

    taken = found.select("row", F.explode("base").alias("b")).select("row", F.col("b.start").alias("b_start"), F.col("b.end").alias("b_end"))
    taken = zoned(taken.withColumnsRenamed({"b_start": "start", "b_end": "end"})).withColumnsRenamed({"start": "b_start", "end": "b_end"})
    near = zoned(likely(hits, "row", taken.select("row")))
    meet = near.join(taken, ["row", "zone"]).where((F.col("b_start") < F.col("end")) & (F.col("start") < F.col("b_end")))
    meet = stored(meet.select("row", "start").distinct())
    outside = hits.join(meet, ["row", "start"], "left_anti")
    added = F.array_sort(F.collect_list(F.struct(F.lit(4).alias("kind"), "start", "end", "value")))
    told = found.drop("contexts").join(stored(outside.groupBy("row").agg(added.alias("added"))), "row", "left")
    return stored(told.select("row", "base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added")))


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    blank = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), digest(utf8(F.col(text))).alias("text_key"), blank.alias("text"))


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text_key, base (array of kind, start, end, value) and added (array of kind, start, end, value).

    Places are in code points, the end exclusive; ``value`` of an added span is ``removed`` or the class it
    is generalised to, by the greatest share the term has of an entity. Kinds may overlap. A null text is
    empty and has no spans; a text without base spans has the added spans of its terms. Repeated rows get
    equal results; an empty table gives no rows; null ids are kept. Only the named columns are read.
    """
    source = _source(docs, key, text)
    result = _found(*_distinct(source)).withColumnRenamed("row", "text_key")
    return source.select("doc_id", "text_key").join(result, "text_key").select("doc_id", "text_key", "base", "added")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["kind"].alias("k"), s["end"].alias("e"))))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["s"].cast("string"), s["e"].cast("string"))), ","
    )


def _clean(text: Column, spans: Column) -> Column:
    """The text with its spans taken out; spans that overlap are one and go by the first, then the longest.

    The text between spans is looked up in pieces, so that the work does not grow with the square of its length.
    """
    names = F.array(*map(F.lit, KINDS))

    def between(pieces, a, b):
        i, j = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
        first = F.get(pieces, i)
        last = F.coalesce(F.substring(F.get(pieces, j), F.lit(1), b % PIECE), F.lit(""))
        middle = F.array_join(F.slice(pieces, i + 2, j - i - 1), "")
        apart = F.concat(F.coalesce(F.substring(first, a % PIECE + 1, F.lit(PIECE)), F.lit("")), middle, last)
        return F.when(a == b, "").when(i == j, F.substring(first, a % PIECE + 1, b - a)).otherwise(apart)

    def rebuilt(own):
        pieces, ordered, floors = own["pieces"], own["spans"], own["floors"]

        def step(span, floor):
            kind = F.concat(F.lit("["), F.get(names, span["kind"]), F.lit("]"))
            label = F.when(span["kind"] < 4, kind).when(span["value"] == "removed", "").otherwise(span["value"])
            return F.when(span["start"] >= floor, F.concat(between(pieces, floor, span["start"]), label)).otherwise("")

        body = F.array_join(F.zip_with(ordered, F.slice(floors, F.lit(1), F.size(ordered)), step), "")
        return F.concat(body, between(pieces, F.get(floors, F.size(ordered)), F.length(text)))

    order = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["value"].alias("value")))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def with_floors(ordered):
        floors = _before(F.transform(ordered, lambda s: -s["back"]), F.greatest)
        return _bound(F.struct(pieces.alias("pieces"), ordered.alias("spans"), floors.alias("floors")), rebuilt)

    return _bound(F.array_sort(order), with_floors)


def _sanitised(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(row, base, added, clean) of the texts with spans; no other text is shuffled."""
    some = found.where((F.size("base") > 0) | (F.size("added") > 0))
    joined = likely(texts, "row", some).join(some, "row")
    return joined.select("row", "base", "added", _clean(F.col("text"), F.concat("base", "added")).alias("clean"))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term, n_generalised, n_removed, clean_sha256.

    ``clean_sha256`` is of the text that ``sanitised`` gives; a null text counts as empty. Nulls, repeated
    rows, empty tables and other columns as for ``personal_spans``.
    """
    source = _source(docs, key, text)
    texts, total = _distinct(source)
    told = _sanitised(texts, _found(texts, total))
    removed = F.size(F.filter("added", lambda s: s["value"] == "removed")).cast("long")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    each = stored(
        told.select(
            F.col("row").alias("text_key"),
            *(count(i).alias(f"n_{KINDS[i]}") for i in range(4)),
            F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
            _joined(F.concat("base", "added")).alias("spans"),
            F.size("added").cast("long").alias("n_term"),
            (F.size("added") - removed).alias("n_generalised"),
            removed.alias("n_removed"),
            F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256"),
        )
    )
    rows = source.select("doc_id", "text_key", F.sha2(utf8(F.col("text")), 256).alias("own_sha256"))
    zero, empty = F.lit(0).cast("long"), F.sha2(F.lit("").cast("binary"), 256)
    defaults = {"base_sha256": empty, "spans": F.lit(""), "clean_sha256": F.col("own_sha256")}
    columns = [F.coalesce(name, defaults.get(name, zero)).alias(name) for name in each.columns if name != "text_key"]
    return rows.join(each, "text_key", "left").select("doc_id", *columns)


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with personal data taken out of ``text``: base spans become their kind in brackets,
    generalised terms their class, removed terms go. Overlapping spans are one, which goes by the first,
    then the longest. Null texts stay null; repeated rows stay; other columns are passed on."""
    texts, total = _distinct(_source(docs, key, text))
    clean = stored(_sanitised(texts, _found(texts, total)).select(F.col("row").alias("text_key"), "clean"))
    marked = docs.select(whole(docs).alias("own"), digest(utf8(F.col(text))).alias("text_key"))
    joined = marked.join(clean, "text_key", "left")
    body = F.coalesce("clean", F.col("own").getField(text))
    return joined.select(F.col("own").withField(f"`{text}`", body).alias("own")).select("own.*")
