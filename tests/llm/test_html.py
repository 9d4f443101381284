"""HTML extraction: deep, long and unmarked pages, and pages alone against pages in their host."""

import random

from stationlens.llm import html

SHAPE = "page_id long, url string, html string, wrapper string, host string, text string"


def texts(spark, pages):
    rows = [(i, u, h, "x", "x", "x") for i, u, h in pages]
    found = html.main_text(spark.createDataFrame(rows, SHAPE).repartition(3)).collect()
    assert len(found) == len(pages) and all(r.n_chars == len(r.text) for r in found)
    return {r.page_id: r.text for r in found}


def test_deep_pages_are_read_whole(spark):
    deep = lambda n, x: "<div>" * n + x + "</div>" * n
    side = "<div class='s'>Aside text of the site.</div>"
    pages = [(i, "http://deep.com/x", f"<body>{side}{deep(20 + 15 * i, f'<article><h1>Title {i}</h1><p>Body {i}</p></article>')}{side}</body>") for i in range(6)]
    pages += [(10 + i, "http://bare.com/x", f"<body>{side}{deep(30 * i, f'<p>Story {i} ' + 'has a long text of its own ' * 9 + '</p>')}</body>") for i in range(1, 5)]
    pages += [(20, "http://very.com/x", "<body>" + deep(5000, "<p>At the bottom.</p>") + "</body>")]
    found = texts(spark, pages)
    assert all(found[i] == f"Title {i}\nBody {i}" for i in range(6))
    assert all(found[10 + i].endswith("of its own") and f"Story {i} has" in found[10 + i] for i in range(1, 5))
    assert found[20] == "At the bottom."


def test_a_word_of_a_class_is_a_hint_only(spark):
    page = "<body class='home'><div class='site has-sidebar'><div class='header-fixed'><main><h1>Title {0}</h1><p>Body {0}</p><div class='comments'><p>Reader {0}</p></div><p class='notice'>We use cookies</p></main></div><div class='sidebar'>Links</div></div></body>"
    plain = "<body><div class='wrap no-sidebar'><div class='post'><h1>Title {0}</h1><p>Body {0} has some text of its own.</p></div></div><div class='sidebar'>Links</div></body>"
    found = texts(spark, [(i, "http://a.com/x", page.format(i)) for i in range(6)] + [(10 + i, "http://b.com/x", plain.format(i)) for i in range(6)])
    assert all(found[i] == f"Title {i}\nBody {i}" for i in range(6))
    assert all(found[10 + i] == f"Title {i}\nBody {i} has some text of its own." for i in range(6))


def test_long_template_texts_are_known(spark):
    legal = "All rights are reserved, and no part of this site may be copied, " * 8
    page = "<body><div class=c><p>Story {0} " + "has a text that is its own and of some length, {0} " * 20 + "</p><p>" + legal + "</p></div></body>"
    found = texts(spark, [(i, "http://a.com/x", page.format(i)) for i in range(8)])
    assert all(found[i].startswith(f"Story {i}") and "reserved" not in found[i] for i in range(8))


def a_page(rng, i, marked):
    """A page with its own text, and that text."""
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(500)) for _ in range(n))
    blocks = [words(6), *(words(rng.randrange(15, 60)) for _ in range(rng.randrange(1, 8)))]
    body = f"<h1>{blocks[0]}</h1>"
    for b in blocks[1:]:
        kind = rng.randrange(4)
        first, rest = b.split(" ", 1)
        body += [f"<p>{b}</p>", f"<p>{first} <em>{rest}</em></p>", f"<blockquote><p>{b}</p></blockquote>", f"<ul><li>{b}</li></ul>"][kind]
    menu = "".join(f"<li><a href='/{k}'>{words(1)}</a></li>" for k in range(rng.randrange(3, 9)))
    more = "".join(f"<div><a href='/{k}'>{words(4)}</a></div>" for k in range(rng.randrange(6)))
    body = f"<article>{body}</article>" if marked else f"<div class='c17'>{body}</div>"
    comments = "".join(f"<div class='comment'><p>{words(9)}</p></div>" for _ in range(rng.randrange(4)))
    page = f"<body><div class='top'><ul>{menu}</ul></div><div class='x3'>{body}</div><div class='x4'>{more}</div><div id='comments'>{comments}</div><div class='x9'>Imprint and terms of this site</div></body>"
    return (i, f"http://{'marked' if marked else 'plain'}{i % 3}.com/{i}", page), "\n".join(blocks)


def test_pages_alone_and_in_their_host(spark):
    rng = random.Random(2)
    made = [a_page(rng, i, i < 60) for i in range(120)]
    expected = {page[0]: text for page, text in made}
    found = texts(spark, [page for page, _ in made])
    alone = texts(spark, [(i, f"http://h{i}.com/", h) for (i, _, h), _ in made])
    for i in range(60):  # a marked region is that of the page itself
        assert found[i] == alone[i] == expected[i]
    right = said = wanted = 0
    for i in range(60, 120):
        a, b = found[i].split(), expected[i].split()
        both = len(set(a) & set(b))
        right, said, wanted = right + both, said + len(set(a)), wanted + len(set(b))
    assert right / said > 0.98 and right / wanted > 0.98
