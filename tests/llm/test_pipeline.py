"""The chained stages against plain Python, stage by stage, on a small planted corpus."""

import base64
import hashlib
import random
import re
import struct
from itertools import combinations

import public_tokenizers
import pytest

import corpus_pipeline

VILE = ["vileness", "scumbag", "filthmonger", "hatefulness"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, prose, tmp_path_factory):
    """The folder, the documents' texts by id, the toxic ids and the benchmark's texts."""
    chance, texts, toxic = random.Random(17), {}, set()
    for i in range(160):  # plain and toxic texts; three in four are labelled
        words = prose(1000 + i, 60 + i % 50).split()
        if i % 4 == 0:
            toxic.add(i)
            for _ in range(6):
                words.insert(chance.randrange(len(words)), chance.choice(VILE))
        texts[i] = " ".join(words)
    items = [f"{prose(5000 + i, 22)}.\n{prose(6000 + i, 12)}" for i in range(8)]
    for i in range(20):  # exact copies, other white space; the longest stays
        texts[200 + i] = texts[1 + 4 * (i % 7)].replace(" ", "  " if i % 2 else "\n", i)
    near = [prose(7000 + i, 150) for i in range(4)]
    for i in range(40):  # families of near copies: some above the similarity, some not, some through others
        words = near[i % 4].split()
        for place in range(chance.randrange(0, 6)):
            words[(17 * i + 23 * place) % len(words)] = f"new{i}x{place}"
        texts[300 + i] = " ".join(words)
    for i in range(8):  # contained items, whole, in upper case, and half of one
        held = (items[i], items[i].upper(), items[i].split("\n")[0])[i % 3]
        texts[400 + i] = f"{prose(8000 + i, 80)} {held} {prose(9000 + i, 90)}"
    texts |= {500: None, 501: "", 502: " \n", 503: "one two", 504: "one two", 505: "Ünïcode 😀 " * 40}
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", "web", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 5 > 0), int(i in toxic)) for i in range(160) if i % 16 < 12]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, toxic, items


def without_copies(texts):
    kept = {}
    for i, text in sorted(texts.items()):
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = kept.get(plain)
        if best is None or len(text or "") > len(texts[best] or ""):
            kept[plain] = i
    return {i: texts[i] for i in sorted(kept.values())}


def without_near_copies(texts):
    """All pairs at five words and 0.8; the least id of a component stays."""
    sets, root = {}, {i: i for i in texts}
    for i, text in texts.items():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: t for i, t in texts.items() if find(i) == i}


def without_items(texts, items):
    """An item is contained if its words, in order, are: halves of items are not."""

    def plain(text):
        return f" {' '.join(re.sub(r'[^0-9a-z]+', ' ', (text or '').lower()).split())} "

    return {i: t for i, t in texts.items() if not any(plain(item) in plain(t) for item in items)}


def digests(texts):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = set()
    for i, text in texts.items():
        ids = library.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        out.add((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def test_each_stage_and_the_chain(spark, corpus, tmp_path):
    folder, texts, toxic, items = corpus
    want = [{i: t for i, t in texts.items() if i not in toxic}]
    want.append(without_copies(want[-1]))
    want.append(without_near_copies(want[-1]))
    want.append(without_items(want[-1], items))
    assert [len(texts), *map(len, want)] == sorted({len(texts), *map(len, want)}, reverse=True)  # every stage has work
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        out = f"{tmp_path}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        assert sorted(docs.columns) == ["doc_id", "lang", "n_chars", "source", "text"]
        assert sorted((r.doc_id, r.text) for r in docs.collect() if r.text is not None) == sorted(
            (i, t) for i, t in expected.items() if t is not None), name
        assert {r.doc_id for r in docs.collect()} == expected.keys(), name
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) == len(want[-1])
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == digests(want[-1])
