"""Packing, language ID and HTML extraction."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stationlens.llm import html, langid, packing
from stationlens.llm.shared import table


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def expected_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(found, capacity):
    """Sequences are gapless and full, or of a power of two."""
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0 and at <= capacity


def test_packing_is_a_round_trip(make, corpus, tokenizer):
    found = packing.pack_documents(make(corpus), capacity=256).collect()
    check(found, 256)
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    for key in {i for i, _ in corpus}:
        texts = [expected_ids(tokenizer, t) for i, t in corpus if i == key]
        assert sum(r.length for r in pieces[key]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces[key], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(texts[0])
                assert r.ids_crc32 == zlib.crc32(np.array(texts[0][at : at + r.length], "<u4").tobytes())
                at += r.length


def test_packing_whole_tables(spark, sf, make):
    found = packing.pack_documents(table(spark, sf, "documents")).collect()
    check(found, 4096)
    assert packing.pack_documents(make([])).collect() == []


def test_words_are_looked_up_right(tokenizer):
    words = packing.WordTokenizer(public_tokenizers.path(packing.TOKENIZER), most=30)
    texts = ["It's I'LL don't 12 34", "ΑΣ ας ΣΑΣ", "x\x1cy z", "é É é", "İstanbul ŉ Straße ﬁ", "<|endoftext|> a", "a\x02b \x02", None, "", " x y\u0085z", "w" * 500]
    for _ in range(2):
        for text, code in zip(texts, words.encode(texts)):
            assert np.frombuffer(code, "<u4").tolist() == expected_ids(tokenizer, text)[:-1]


def test_conversations_keep_all_limits(spark, tokenizer):
    turns = [(c, t, "assistant" if t % 2 else "user", f"word{c} " * (5 + (c * 7 + t) % 90)) for c in range(60) for t in range(2 + c % 5)] + [(99, 0, None, None)]
    found = packing.pack_conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), capacity=512, max_segments=4, max_loss=200).collect()
    whole = {}
    for c, _, role, text in sorted(turns, key=lambda x: x[:2]):
        ids = expected_ids(tokenizer, text)
        whole.setdefault(c, []).extend([(i, role == "assistant") for i in ids])
    sequences = {}
    for r in found:
        part = whole[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array([i for i, _ in part], "<u4").tobytes())
        s = sequences.setdefault(r.sequence_id, [0, 0, 0])
        s[0] += r.length
        s[1] += 1
        s[2] += sum(b for _, b in part)
    assert all(a <= 512 and b <= 4 and c <= 200 for a, b, c in sequences.values())
    assert sum(r.length for r in found) == sum(map(len, whole.values()))


def test_language_of_held_out_rows(spark, sf):
    docs = table(spark, sf, "documents")
    held = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(4)) == 2
    found = langid.predict(docs, langid.fit(docs.where(~held))).where(held).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert sum(r.rejected for r in found) <= 0.03 * len(found) and all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark, sf, make, corpus):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs)
    rows = make([(1, None), (2, ""), (3, "12 34 !?"), (4, "the"), (5, "x" * 200_000), (None, "der die das und"), (5, "x")])
    found = langid.predict(rows.withColumn("score", F.lit("clash")), model).collect()
    assert len(found) == 7 and {r.doc_id for r in found if r.lang_pred == "und"} == {1, 2, 3}
    assert all(r.score == 0 and r.rejected for r in found if r.lang_pred == "und")
    assert langid.predict(make([]), model).collect() == []
    none = langid.fit(docs.where("false"))
    assert {r.lang_pred for r in langid.predict(make(corpus), none).collect()} == {"und"}
    assert langid.fit(docs.withColumn("lang", F.lit(None).cast("string"))).languages == []


def test_short_texts_are_rejected_by_distance(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs)
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."
    russian = "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства."
    rng = np.random.default_rng(4)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), n)) for n in (60, 120, 180)]
    assert all(langid.label([t[:n] for t in (polish, russian) for n in (60, 120, 170)] + noise, model)[2])
    clean = [r.text[a : a + n] for r in docs.where("n_chars > 1500").limit(60).collect() for a in (200, 700) for n in (40, 80, 160)]
    assert np.mean(langid.label(clean, model)[2]) < 0.05
    token = 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" '
    assert np.mean(langid.label([token + t for t in clean], model)[2]) < 0.05


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/a">menu</a><li>two</ul></nav>
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><h1>Head &lt;{0}&gt;</h1><p>One <b>bold</b>
 text&nbsp;{0}<p>Two<br>lines<aside>Side</aside><form>Mail <input></form><ul><li>a<li>b</ul><blockquote><p>Quote</p></blockquote><!-- no --><div class="comments">Me too</div></article><aside>More</aside><footer>&copy;</footer></body></html>"""


def test_main_text(spark):
    pages = [(i, f"http://h{i % 2}.com/{i}", PAGE.format(i)) for i in range(8)] + [(8, None, None), (9, "http://x.com", ""), (10, "http://h0.com/cut", PAGE.format(10)[:520]), (10, "http://h0.com/cut", PAGE.format(10)[:520]), (11, "http://y.com", "plain text < 3"), (12, "http://y.com", "<p" * 50)]
    found = {r.page_id: r for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert found[3].text == "Head <3>\nOne bold text 3\nTwo lines\na\nb\nQuote" and found[3].n_chars == len(found[3].text)
    assert found[8].text == found[9].text == "" and found[8].n_chars == 0 and found[8].url is None
    assert found[10].text.startswith("Head <10>\nOne") and found[11].text == "plain text < 3"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_template_text_without_a_marked_region(spark):
    page = "<body><div id=top><a href=/>Home</a> Welcome to the site</div><div class=content><p>Story number {0} has a long text of its own, so it is the body.</p><h4>Read more on our site</h4></div><div>Imprint</div></body>"
    pages = [(i, "http://plain.com/x", page.format(f"{i} " + "word " * (5 + i))) for i in range(9)]
    found = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(t.startswith(f"Story number {i} ") and "\n" not in t for i, t in found.items())


def test_wrappers_have_optional_and_repeated_groups():
    a = html.wrapper_of(html.parse("<body><h1>x</h1><p>one</p><p>two</p><div>same</div></body>"))
    b = html.wrapper_of(html.parse("<body><h1>y</h1><span>new</span><p>three</p><div>same</div></body>"))
    html.align(a, b)
    assert html.expression(a) == "<#><body><h1>#TEXT</h1>(<span>new</span>)?(<p>#TEXT</p>)+<div>same</div></body></#>"


def test_host_of_many_classes(spark):
    """Each page has classes of its own, so that the host's wrapper grows beyond its size."""
    words = lambda i: " ".join(f"w{i * 7 + k}" for k in range(4))
    bio = "<div class='bio'>" + "The author has written here for years, and so on and on. " * 20 + "</div>"
    marked = [f"<body><p>Top</p><article class='post-{i}'><div class='body-{i}'><h1>{words(i)}</h1><p>Text {i}</p></div></article>{bio}</body>" for i in range(300)]
    # a region of any class that holds no region of its own, beside one that does
    marked += [f"<body><main class='page-{i}'><p>Page {i}</p></main><div class='x-{i}'><article>Teaser</article></div>{bio}</body>" for i in range(300, 303)]
    marked += [f"<body><main class='list-{i}'><article class='a-{i}'>Item {i}</article></main>{bio}</body>" for i in range(303, 306)]
    plain = [f"<body><div class='post-{i}'><h1>{words(i)}</h1><section class='s-{i}'>Text {i} " + "of its own " * 30 + f"</section></div><div class='bio'>Bio of {i % 3}</div></body>" for i in range(300)]
    pages = [(i, "http://marked.com/x", p) for i, p in enumerate(marked)] + [(1000 + i, "http://plain.com/x", p) for i, p in enumerate(plain)]
    found = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(300):
        assert found[i] == f"{words(i)}\nText {i}"
        assert words(i) in found[1000 + i] and f"Text {i} of its own" in found[1000 + i]
    assert all(found[i] == f"Page {i}\nTeaser" for i in range(300, 303))
    assert all(found[i] == f"Item {i}" for i in range(303, 306))
