"""Archives, encoding, line rules, page text, URL filter: against brute force, round trips and hand-worked answers."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import byte_bpe, html_density, line_rules, urls, warc
from tallyframe.llm.queries import URL_RULES
from tallyframe.llm.rowwise import BATCH_BYTES, per_text
from tallyframe.sources.shared import shared_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "Längere Wörter und words, " * 8000


def table(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


PAGES = [(1, "http://a/", "same"), (5, "http://b/\r\nX: 1", "same"), (3, None, "same"), (2, "u", None), (4, "u", ""), (None, "n", "same"),
         (9, "z", LONG), (8, "z", LONG), (8, "z", LONG), (7, "w", "single")]


def expected(rows, least=0):
    heads = {}
    for k, _, h in rows:
        if k is not None and len((h or "").encode()) >= least:
            heads[h or ""] = max(k, heads.get(h or "", k))
    out = []
    for k, _, h in rows:
        h = h or ""
        refers = heads.get(h) if k is not None and heads.get(h, k) != k else None
        out.append((k, len(h.encode()), b32(h), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def read_back(df):
    number = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).try_cast("bigint")
    rows = df.where("gap is null").select(number("record_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, least):
    df = table(spark, [(*r, 0) for r in PAGES], "page_id long, url string, html string, record_type int")
    path = shared_path(spark, "warc")
    warc.write_archives(df, path, min_bytes=least, archive_bytes=1 << 18)
    got = warc.read_archives(spark, path)
    assert read_back(got) == expected(PAGES, least)
    assert got.where("gap is not null").count() == 0
    payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in got.where("payload is not null").collect()}
    assert payloads["urn:page:9"] == LONG
    assert got.where("record_id = 'urn:page:5'").head()["uri"] == "http://b/%0D%0AX: 1"


def test_no_pages_no_records(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(table(spark, [], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def archive(n, plain):
    parts = [warc.record("response", f"urn:page:{i}", "2024-01-01T00:00:00Z", "u", f"body {i} ".encode() * (i + 1)) for i in range(n)]
    return [p if plain else warc.member(p) for p in parts]


def names(data):
    found = list(warc.salvage(data))
    assert sum(e - s for s, e, x in found if isinstance(x, str)) + sum({(s, e): e - s for s, e, x in found if not isinstance(x, str)}.values()) == len(data)
    return [x["head"]["warc-record-id"] for *_, x in found if not isinstance(x, str)], [(s, e) for s, e, x in found if isinstance(x, str)]


@pytest.mark.parametrize("plain", [True, False])
def test_salvage_recovers_all_other_records(plain):
    rng = random.Random(4)
    parts = archive(12, plain)
    every = [f"<urn:page:{i}>" for i in range(12)]
    assert names(b"".join(parts)) == (every, [])
    for _ in range(150):
        at = rng.randrange(12)
        bad, place = bytearray(parts[at]), rng.randrange(len(parts[at]))
        kind = rng.randrange(3)
        if kind == 0:
            bad = bad[:place]
        elif kind == 1:
            bad[place:place] = bytes(rng.randrange(256) for _ in range(9))
        else:
            bad = bytearray(len(bad))
        data = b"".join([*parts[:at], bytes(bad), *parts[at + 1:]])
        found, gaps = names(data)
        # a plain record's header has no digest: damage may leave it sound under another name
        assert [x for x in found if x in every and x != every[at]] == [x for x in every if x != every[at]]
        start = sum(map(len, parts[:at]))
        assert all(start <= s and e <= start + len(bad) for s, e in gaps)


def test_salvage_checks_digests_and_mixed_files():
    parts = archive(3, True)
    wrong = parts[1].replace(b"body 1", b"BODY 1")
    assert names(parts[0] + wrong + parts[2])[0] == ["<urn:page:0>", "<urn:page:2>"]
    mixed = warc.member(parts[0]) + parts[1] + gzip.compress(parts[2] + parts[0]) + b"junk"
    assert names(mixed)[0] == [f"<urn:page:{i}>" for i in (0, 1, 2, 0)]
    assert names(b"")[0] == [] and names(b"\0" * 9) == ([], [(0, 9)])


def test_salvage_inside_members():
    rng = random.Random(7)
    parts = [warc.record("response", f"urn:page:{i}", "2024-01-01T00:00:00Z", "u", bytes(rng.randrange(256) for _ in range(3000))) for i in range(8)]
    wrong = parts[2].replace(b"HTTP/1.1 200", b"HTTP/1.1 500")
    ids = lambda data: [x["head"]["warc-record-id"][10:-1] for *_, x in warc.salvage(data) if not isinstance(x, str)]
    gaps = lambda data: [x for *_, x in warc.salvage(data) if isinstance(x, str)]
    one = gzip.compress(b"".join([*parts[:2], wrong, *parts[3:]]))
    assert ids(one) == list("0134567") and gaps(one) == [f"in a member, bytes {sum(map(len, parts[:2]))} to {sum(map(len, parts[:3]))}: warc-block-digest differs"]
    whole = gzip.compress(b"".join(parts))
    after = warc.member(parts[0].replace(b"urn:page:0", b"urn:page:9"))
    for lost in (4, 9, len(whole) // 2):
        got = ids(whole[:-lost])
        assert got == list("01234567")[:8 if lost == 4 else len(got)] and len(got) >= (7 if lost < 10 else 3)
        assert gaps(whole[:-lost])[0].startswith("member is cut off")
        assert ids(whole[:-lost] + after)[-1] == "9" and set(got) <= set(ids(whole[:-lost] + after))
    bad = whole[:-8] + b"\0\0\0\0" + whole[-4:]
    assert names(bad + after)[0] == [f"<urn:page:{i}>" for i in (*range(8), 9)] and "incorrect data check" in gaps(bad)[0]
    stored = gzip.compress(b"".join(parts), 0)[:-8]
    assert ids(stored + after) == [*"01234567", "9"]


TEXTS = [None, "", " ", "a", "Ça et là — 日本語 🙂\x00\x1f\x85", "  two  spaces\n\n\t x", "<|endoftext|> don't", LONG, LONG, "=" * 5000, "\ue000 ▁ Ġ"]


def test_bpe_equals_tiktoken(spark):
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(VOCABULARY))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = table(spark, [(i if i else None, t, 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_tokens int")
    coded = byte_bpe.encode_documents(df, VOCABULARY, public_tokenizers.PATTERN)
    rows = {r["doc_id"] or 0: r for r in coded.collect()}
    for i, text in enumerate(TEXTS):
        ids = reference.encode_ordinary(text or "")
        assert rows[i]["ids"] == ids and rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    back = {r["doc_id"] or 0: bytes(r["bytes"]) for r in byte_bpe.decode_ids(coded, VOCABULARY).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert byte_bpe.encode_documents(df.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_random_characters():
    tokens = byte_bpe.read_ranks(VOCABULARY)
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    coder, rng = byte_bpe.ByteBpe(byte_bpe.serialised_model(tokens), public_tokenizers.PATTERN), random.Random(3)
    for _ in range(2000):
        text = "".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0x2000, 0x2070), 0x1F600, 0x4E00])) for _ in range(rng.randrange(14)))
        assert coder.encode(text) == reference.encode_ordinary(text)


def test_bpe_remembers_as_many_parts_as_asked(spark, monkeypatch):
    """Unlike words by the ten thousand do not stay with a worker, and are encoded as by a fresh coder; the pipeline asks for few."""
    model = byte_bpe.serialised_model(byte_bpe.read_ranks(VOCABULARY))
    coder = byte_bpe.ByteBpe(model, public_tokenizers.PATTERN, remembered=5_000)
    fresh, most = byte_bpe.ByteBpe(model, public_tokenizers.PATTERN), 0
    for start in range(0, 30_000, 500):
        text = " ".join(f"w{i}x" for i in range(start, start + 500))
        ids = coder.encode(text)
        most = max(most, len(coder.known))
        assert ids == fresh.encode(text) and coder.decode(ids) == text.encode()
    assert most <= 7_000 and len(fresh.known) >= 30_000
    asked = []
    monkeypatch.setattr(byte_bpe, "encode_documents", lambda *a, **options: asked.append(options["remembered"]))
    corpus_pipeline.encoding_stage(spark, None, "")
    assert asked == [50_000]


GOOD = "The quick report was read by everyone in the small office on that day. It held up well."


@pytest.mark.parametrize(("line", "rule"), [
    (GOOD, None), ("Short.", None), ("one | two | three | four", "navigation"), ("Home", "navigation"), ("Log in", "punctuation"),
    ("word### other$$$ thing%%% more&&&", "symbols"), ("ALL OF THIS IS LOUD.", "shouting"), ("wow!! so!! much!! noise", "punctuation"),
    ("same same same same same same same same same same.", "repetition"), ("All rights reserved.", "boilerplate"),
    ("a line that just stops", "punctuation"), ("\u3000", None)])
def test_line_rules(line, rule):
    assert line_rules.failing(line) == rule


def test_cleaning(spark):
    good = "\n".join(f"Line {i} tells of {i * 7} boats, {i * 3} carts and number {i + 50}. It ends after {i + 90} words." for i in range(7))
    rows = [(1, good), (2, good + "\nHome\nAll rights reserved."), (3, None), (4, ""), (5, "word " * 80), (6, good + "\n" + "x| y| " * 400),
            (7, good + "\n\n" + good), (None, good), (1, good)]
    found = line_rules.clean_lines(table(spark, [(*r, 0) for r in rows], "doc_id long, text string, kept int")).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and [by[i]["kept"] for i in range(1, 8)] == [True, True, False, False, False, False, False]
    assert by[2]["clean_text"] == good and by[2]["n_removed_lines"] == 2
    assert (by[3]["n_words"], by[3]["base_failed"], by[3]["clean_text"]) == (0, True, "")
    assert by[5]["n_repeat_words"] == 80 and by[7]["n_dup_lines"] == 7 and by[None]["kept"]
    assert line_rules.measures("a b c a b c") == (6, 6, 0, 0, 6)
    assert line_rules.measures("x\n \nx\ny#|") == (3, 5, 2, 1, 0)


BODY = "<article><h1>Head &amp; tail</h1><p>First  paragraph with <b>some</b>\nwords, and more of them.<p>Second one, with a <a href=x>link</a> in it.</article>"
MAIN = "Head & tail\nFirst paragraph with some words, and more of them.\nSecond one, with a link in it."


@pytest.mark.parametrize(("html", "text"), [
    (BODY, MAIN), (None, ""), ("", ""), ("<p>", ""), ("just text", "just text"),
    (f"<nav><a href=1>Menu</a></nav><div class='ad'>Buy now, buy cheap, buy more of it.</div>{BODY}<footer>&copy; x</footer>", MAIN),
    (f"<script>var t='</p>';</script><style>p{{}}</style><form>Name</form>{BODY}<div id='comments'><p>I like it a lot, yes I do.</p></div>", MAIN),
    (f"<html><body><div><div><ul>{'<li><a href=1>One of the links</a></li>' * 30}</ul></div><div>{BODY[9:-10]}</div></div>", MAIN),
    (BODY[:-10], MAIN), (BODY + "</div></p></span>", MAIN), ("<div>" * 3000 + "deep", "deep")])
def test_main_text(html, text):
    assert html_density.main_text(html) == text


SENTENCE = "Boats went down the river while the people on the bank were waiting for news of the harvest and the weather. "
PARTS = [[f"Part {i} paragraph {j}. {SENTENCE * 2}".strip() for j in range(5)] for i in range(3)]


@pytest.mark.parametrize("tag", ["section", "div"])
def test_articles_in_sections_are_whole(tag):
    inner = "<h1>Short title</h1>" + "".join(f"<{tag}>{''.join(f'<p>{p}</p>' for p in part)}</{tag}>" for part in PARTS)
    links = f"<div><ul>{'<li><a href=1>One of the links</a></li>' * 30}</ul></div>"
    assert html_density.main_text(f"<body>{links}<article>{inner}</article>{links}</body>") == "\n".join(["Short title", *sum(PARTS, [])])


@pytest.mark.parametrize("name", ["content no-sidebar", "with-sidebar", "has-share", "post-header", "sidebar"])
def test_wrappers_are_no_furniture(name):
    assert html_density.main_text(f'<div class="{name}">{BODY}</div>') == MAIN


def test_captions_stay():
    html = "<article>" + "".join(f"<p>{p}</p>" for p in PARTS[0]) + "<figure><img src=x><figcaption>A boat.</figcaption></figure></article>"
    assert html_density.main_text(html) == "\n".join([*PARTS[0], "A boat."])


def test_pages_in_spark(spark):
    rows = [(1, "u", BODY, "x"), (1, "u", BODY, "x"), (None, None, None, "x"), (2, "v", f"<article><p>{LONG}</p></article>", "x")]
    found = html_density.extract_main_text(table(spark, rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found), key=str) == sorted(
        [(1, "u", MAIN, len(MAIN))] * 2 + [(None, None, "", 0), (2, "v", LONG.strip(), len(LONG.strip()))], key=str)


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/casino", "", "", None, "block"),
    ("http://News.Example.ORG/en/2?x#y", "news.example.org", "/en/2", "org/", "allow"),
    ("http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/es/", "example.org", "/es/", "example.org/es/", "block"), ("http://casino.org/", "casino.org", "/", "org/", "allow"),
    ("http://myexample.org", "myexample.org", "", None, "allow"), ("http://x.com/fr/casino", "x.com", "/fr/casino", "com/fr/", "allow"),
    ("http://www.casino-win.example.net/", "www.casino-win.example.net", "/", None, "block"),
    ("http://occasino.net/", "occasino.net", "/", None, "allow"), ("http://free.net/free?free", "free.net", "/free", None, "allow"),
    ("http://free-bets.net?q=://z", "free-bets.net", "", None, "block"), ("a://b://c/d", "b:", "//c/d", None, "allow")])
def test_url_verdicts(spark, url, host, path, rule, verdict):
    book, words = urls.Rules(URL_RULES), urls.Vocabulary(urls.STRICT_TERMS, urls.SOFT_TERMS)
    assert urls.parts(url) == (host, path)
    fitting = book.fitting(host, path)
    hard, soft = words.hits(url or "")
    assert (fitting.name if fitting else None, fitting.verdict if fitting else "block" if hard or len(soft) > 1 else "allow") == (rule, verdict)


def test_urls_in_spark(spark):
    rows = [(1, "http://free-bets.net/", "h"), (1, "http://free-bets.net/", "h"), (None, None, "h"), (2, "http://y.net/" + "adult/" * 20000, "h")]
    found = urls.judge_urls(table(spark, rows, "page_id long, url string, host string"), rules=URL_RULES).collect()
    assert sorted(((r["page_id"], r["verdict"], r["soft_hits"]) for r in found), key=str) == sorted(
        [(1, "block", 2), (1, "block", 2), (None, "allow", 0), (2, "allow", 1)], key=str)


PARAGRAPHS = [f"Paragraph {i} says a number of things about the matter at hand, one after the other, in plain words." for i in range(5)]
ARTICLE = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
MENU = "<div><a href=/a>One</a> <a href=/b>Two</a> <a href=/c>Three</a> <a href=/d>Four</a></div>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>A title</title><meta charset=utf-8><body>{MENU}<div>{ARTICLE}</div></body></html>",  # </head> is optional
    f"<head><title>A title</title><link rel=x><div>{ARTICLE}</div>",
    f"<head><script>var x = '<p>no';</script><style>p {{}}</style>{ARTICLE}",
    f"<html><title>A title</title>{MENU}<div class='social-science'>{ARTICLE}</div></html>",
    f"{MENU}<div class='article-with-comments'>{ARTICLE}</div><footer>All rights reserved</footer>",
    f"{MENU}<div id=content class='sponsored'><div class='share-post popup'>{ARTICLE}</div></div>",
    f"{MENU}<aside><p>An aside nobody closed<div>{ARTICLE}</div>",
    f"<form action=/>{MENU}<div>{ARTICLE}</div><input name=q><button>Go</button></form>",
    f"<header><h1></h1>{ARTICLE}",
])
def test_ordinary_pages_keep_their_article(page):
    text = html_density.main_text(page)
    assert text.split("\n")[-5:] == PARAGRAPHS and "title" not in text and "rights" not in text and "One Two" not in text


def test_furniture_of_any_share_short_of_most_goes():
    comments = "".join(f"<div class=comment><p>{p} I think so too.</p></div>" for p in PARAGRAPHS * 2)
    page = f"<nav>{MENU}</nav><article>{ARTICLE}</article><section class=comments>{comments}</section><footer>{PARAGRAPHS[0]}</footer>"
    assert html_density.main_text(page) == "\n".join(PARAGRAPHS)
    assert html_density.main_text(f"<nav>{MENU}</nav><footer>All rights reserved</footer>") == ""
    assert html_density.main_text("<head><title>Nothing else</title>") == ""


def test_very_deep_pages():
    """Stray, unclosed and deep tags cost the same at any depth."""
    import time
    began = time.time()
    for page in ("<div>" * 32_000 + "</span></b></i>" * 32_000 + ARTICLE, "<b>" * 32_000 + "</i>" * 32_000 + ARTICLE,
                 "<i><div>" + "<b>" * 32_000 + "</i>" * 32_000 + ARTICLE, "<ul><li>" * 16_000 + "<li>" * 16_000 + ARTICLE):
        assert html_density.main_text(page).split("\n")[-5:] == PARAGRAPHS
    assert time.time() - began < 20


def plain_measures(text):
    """The base measures as the contract words them, one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i:i + 3])] >= 2}
    doubled = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(repeated)


def test_base_measures_equal_plain_ones(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(-1, None), (-2, ""), (-3, " \n\t\n"), (-4, "a b c a b c\n\na b c\nx \x0b y　z w # $%|"), (-5, "same\nsame \nsame\n\nsame"), (-6, "一二 三\r\n四<>")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r, (_, text) in zip(line_rules.clean_lines(df).orderBy("doc_id").collect(), sorted(docs), strict=True):
        n, chars, symbols, doubled, repeated = plain_measures(text or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, doubled, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and not (r["base_failed"] and r["kept"])


def test_a_task_gets_few_long_texts_at_once(spark):
    """Batches end by bytes, so long texts do not come by the thousand; every row comes; a limit of the session's own stays."""
    limit, length = "spark.sql.execution.arrow.maxBytesPerBatch", 100_000
    docs = spark.range(0, 300, 1, 1).selectExpr("id as doc_id", f"repeat('abcde ', {length // 6}) as text")

    def sizes():
        setup = lambda: lambda texts: [[sum(map(len, texts))] * len(texts)]
        return [r["b"] for r in per_text(docs, "doc_id", "text", [T.StructField("b", T.LongType())], setup).collect()]

    spark.conf.unset(limit)
    try:
        found = sizes()
        assert len(found) == 300 and max(found) <= BATCH_BYTES + length
        spark.conf.set(limit, "1000000")
        assert max(sizes()) <= 1_000_000 + length and spark.conf.get(limit) == "1000000"
    finally:
        spark.conf.unset(limit)
