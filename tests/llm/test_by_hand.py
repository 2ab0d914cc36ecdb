"""URL filter, language ID and the pipeline against plain Python over whole tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from test_near_duplicates import near, removed
from tokenizers import Tokenizer

import corpus_pipeline
from chunkspark.llm import language_id, url_filter
from chunkspark.llm.packing import vocabulary_path
from chunkspark.plans.registry import QUERIES
from chunkspark.session import read_table

PAGES = "/root/testdata/sf0.01"


def plain_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for where, start, says in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == where or host.endswith("." + where)) and path.startswith(start) and (best is None or len(where + start) > len(best[0])):
            best = (where + start, says)
    return host, path, best


def test_urls_of_the_whole_table(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://A.NET", "http://x.Example.NET/en/?a#b", "http://example.net/de", "a://b://c.org/fr/x", "http://nét.net/#?",
           "http://" + "a" * 200_000 + ".net/" + "b" * 200_000, "http://fr.org/fr/", "http://org/fr/#x", "http://myexample.com/de/", "http://x?y=/net/"]
    pages = read_table(spark, PAGES, "pages").select("page_id", "url").collect()
    rows = [(r.page_id, r.url, "clash", 1.5) for r in pages] + [(-1 - i, u, "clash", 2.5) for i, u in enumerate([*odd, *odd])]
    # Columns named like those the operator makes.
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, f_length double")).collect()
    assert len(found) == len(rows)
    got = {r.page_id: r for r in found}
    for page_id, url, _, _ in rows:
        host, path, best = plain_rule(url)
        r = got[page_id]
        assert (r.host, r.path, r.rule) == (host, path, best and best[0]), url
        assert r.verdict == (best[1] if best else "block" if r.block_score >= 0.5 else "allow")


def plain_cosines(text, idf, centers):
    counts = Counter()
    data = (" " + language_id.NOT_LETTERS.sub(" ", text.lower()) + " ").encode()
    for width in (2, 3):
        for at in range(len(data) - width + 1):
            gram = width
            for byte in data[at: at + width]:
                gram = (gram * 257 + byte) % 2**32
            counts[gram * 2654435761 % 2**32 >> 19] += 1
    weights = {cell: math.log1p(n) * float(idf[cell]) for cell, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return [sum(w * float(c[cell]) for cell, w in weights.items()) / norm for c in centers]


def test_languages_are_those_of_the_nearest_centroid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    train = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    model = language_id.fit(docs.filter(~language_id.held_out()))
    # The document frequencies are those of all training rows with a letter.
    rows = [r.text for r in train if r.lang is not None and r.text and re.search(r"[^\W\d_]", r.text)]
    seen = np.zeros(language_id.FEATURES)
    for text in rows:
        data = (" " + language_id.NOT_LETTERS.sub(" ", text.lower()) + " ").encode()
        cells = set()
        for width in (2, 3):
            for at in range(len(data) - width + 1):
                gram = width
                for byte in data[at: at + width]:
                    gram = (gram * 257 + byte) % 2**32
                cells.add(gram * 2654435761 % 2**32 >> 19)
        seen[list(cells)] += 1
    assert np.allclose(model["idf"], np.log((1 + len(rows)) / (1 + seen)) + 1, atol=1e-5)
    found = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf_dir).collect()}
    for r in docs.collect():
        got = found[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        cosines = plain_cosines(r.text, model["idf"], model["centers"])
        best = max(cosines)
        assert abs(got.score - best) < 1e-4
        assert got.lang_pred in {model["langs"][i] for i, c in enumerate(cosines) if c > best - 1e-4}


def test_the_pipeline_by_hand(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    spoken = language_id.accepted(docs, language_id.fit(docs.filter(~language_id.held_out())))
    left = [(r.doc_id, r.text) for r in spoken.collect()]
    assert 0.9 * docs.count() < len(left) <= docs.count()
    newest = {}
    for doc_id, text in left:
        newest[text] = max(newest.get(text, doc_id), doc_id)
    left = [(i, t) for i, t in left if newest[t] == i]
    classes = near(left)
    left = [(i, t) for i, t in left if classes[i][0] == i]
    texts = {i: kept.decode("utf-8", "replace") for i, _, _, _, kept in removed(left, False, 100)}
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    pieces, filled = defaultdict(list), Counter()
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        filled[r.sequence_id] += r.length
    assert sorted(pieces) == sorted(ids)
    for i, want in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = np.array(want[r.start: r.start + r.length], dtype="<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(part))
            at += r.length
        assert at == len(want)
    total = sum(map(len, ids.values()))
    assert len(filled) == -(-total // 2048) and sorted(filled.values())[1:] == [2048] * (len(filled) - 1)
