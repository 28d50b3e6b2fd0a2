"""Blocks by hand, gradients by finite differences, extraction against pages built with known text."""

import html as escape
import random

import numpy as np
import pytest

from fieldhouse.llm import pages as P
from fieldhouse.llm.pages import blocks_of

SCHEMA = "page_id long, url string, html string, text string, row int"


def test_blocks():
    got = blocks_of("<html><head><title>no</title><style>p{}</style></head><body>a<script>var t='</p>'</script> b<p>one <b>two<br>three<p>four&nbsp;&eacute;&#x41;"
                    "<ul><li><a href=x>five</a><li>six</ul><div class='Big ad' id=z>  <!-- c -->seven</div><table><tr><td>8<td>9</table>end")
    assert [t for _, t, _ in got] == ["a b", "one two three", "four éA", "five", "six", "seven", "8", "9", "end"]
    assert [n for _, _, n in got] == [0, 0, 0, 4, 0, 0, 0, 0, 0]
    assert got[5][0] == ("html", "body", "div.ad.big.z") and got[3][0] == ("html", "body", "ul", "li") and got[8][0] == ("html", "body")
    assert blocks_of("") == [] and blocks_of("<p") == [] and blocks_of("<article><p>open")[0][1] == "open"


def test_gradients():
    net, rng = P.Labeller(1), np.random.default_rng(0)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    pages = [blocks_of("<nav>a b c</nav><p>one two<p>three."), blocks_of("<div class=x>one</div>"), blocks_of("<p>a</p>" * 5)]
    f, label = P.Features(pages), np.array([0, 1, 1, 0, 1, 0, 1, 0, 1], float)
    place, mask = P.padded(f.size)

    def loss():
        logit = net.forward(net.inputs(f).astype(np.float64)[place], mask)[mask]
        y, q = label, 1 / (1 + np.exp(-logit))
        return -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))

    g = net.gradients(f, label)
    for k in net.p:
        values, slopes = net.p[k].reshape(-1), g[k].reshape(-1)
        spots = np.flatnonzero(slopes) if k in ("path", "word") else np.arange(len(values))
        for i in rng.choice(spots, min(len(spots), 6), replace=False):
            old = values[i]
            values[i] = old + 1e-2
            up = loss()
            values[i] = old - 1e-2
            down = loss()
            values[i] = old
            assert abs((up - down) / 2e-2 - slopes[i]) < 2e-3, k


def made(rng, main, other, words):
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    body = [say(rng.randrange(5, 60)) + " & <é>" for _ in range(rng.randrange(2, 9))]
    tag, *cls = main.split(".")
    junk = "".join(f"<{o.split('.')[0]} class='{'.'.join(o.split('.')[1:])}'><p>{say(9)}</p></{o.split('.')[0]}>" for o in other)
    page = (f"<html><head><title>{say(5)}</title></head><body><nav><ul><li><a href=/>{say(1)}</a></li></ul></nav><script>x('{say(3)}')</script>"
            f"<{tag} class='{'.'.join(cls)}'>" + "".join(f"<p>{escape.escape(b)}\n</p>" for b in body) + f"</{tag}>{junk}<footer>{say(4)}</footer></body></html>")
    return page, "\n".join(body)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "the ver que ion st".split() for b in "er an os lich ment".split()]
    plain = [made(rng, "article", rng.sample(["aside", "div.ad", "form.newsletter"], 2), words) for _ in range(200)]
    return plain, [made(rng, m, o, words) for m, o in (("div.content", ["div.comments"]), ("main", ["div.cookie-notice", "div.sidebar"]), ("div.post", ["section.comments", "div.ad"])) * 10]


def test_extracts_also_where_names_differ(rows):
    plain, other = rows
    net = P.fit([h for h, _ in plain[:150]])
    assert P.main_text(net, [h for h, _ in plain[150:]]) == [t for _, t in plain[150:]]
    got = P.main_text(net, [h for h, _ in other])
    assert np.mean([g == t for g, (_, t) in zip(got, other)]) > 0.8


def test_tables(spark, rows):
    plain, _ = rows
    long = "<article>" + "".join(f"<p>paragraph {i} of a long page</p>" for i in range(8000)) + "</article>"
    data = [(i, "u", h, "t", 1) for i, (h, _) in enumerate(plain[:60])] + [(None, None, None, None, None), (70, "u", "", "t", 1), (71, "u", long, "t", 1), (3, "u", plain[3][0], "t", 1)]
    got = P.extracted(spark.createDataFrame(data, SCHEMA)).collect()
    text = {r["row"]["page_id"]: r["text"] for r in got}
    assert len(got) == len(data) and text[None] == "" and text[70] == ""
    assert all(text[i] == plain[i][1] for i in range(60)) and text[71].count("\n") == 7999
    assert P.extracted(spark.createDataFrame([], SCHEMA)).collect() == []
    bare = P.extracted(spark.createDataFrame([(1, "u", "<p>no mark at all", "t", 1)], SCHEMA)).collect()
    assert bare[0]["text"] == ""


def test_given_pages(spark, data):
    df = spark.read.parquet(f"{data}/pages.parquet")
    got = {r["row"]["page_id"]: r["text"] for r in P.extracted(df).collect()}
    want = {r["page_id"]: "\n".join(b[1] for b in blocks_of(r["html"]) if P.marked(b[0])) for r in df.collect()}
    assert got == want


def test_only_pages_with_marks_are_drawn(spark, monkeypatch):
    from fieldhouse.llm import pages as P

    monkeypatch.setattr(P, "FIT_PAGES", 10)
    plain = [(i, "", f"<html><body><div><p>plain page {i}</p></div></body></html>") for i in range(300)]
    seeming = [(1000 + i, "", f"<html><body><!-- <article> --><article></article><p>seeming {i}</p></body></html>") for i in range(50)]
    true = [(2000 + i, "", f"<html><body><MAIN\nid=a><p>true {i}</p></MAIN></body></html>") for i in range(12)]
    for rows in (plain + true, plain + seeming + true):
        got = P.sample_of(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        assert len(got) == 10 and all(r["page_id"] >= 2000 for r in got)


def test_pages_without_any_marks_give_text(spark):
    from fieldhouse.llm import pages as P

    html = ("<html><body><nav><a href=x>Home</a></nav><div class='post'><h1>Title</h1><p>A first sentence of the page.</p></div><div><p>Another long "
            "sentence of the page, outside of named elements</p><p><a href=y>all of this is only a link, however long it may be</a></p></div>"
            "<div class='sidebar'><p>A sentence that stands at the side.</p></div></body></html>")
    rows = [(1, "", html), (2, "", "<body><p>Short</p></body>"), (3, "", "<body><h2>Head</h2><p>It ends here.</p><h2>Last</h2></body>"), (4, "", None)]
    out = {r["row"]["page_id"]: r["text"] for r in P.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {1: "Title\nA first sentence of the page.\nAnother long sentence of the page, outside of named elements", 2: "", 3: "Head\nIt ends here.", 4: ""}


def test_tags_may_be_left_out():
    from fieldhouse.llm.pages import blocks_of, main_text

    def texts(html):
        return [b[1] for b in blocks_of(html)]

    head = "<html><head><meta charset=x><title>t</title><style>p {}</style>"
    assert main_text(None, [f"{head}<article><p>text</p></article>", f"{head}<link href=x><article><p>text</p></article></html>"]) == ["text", "text"]
    assert blocks_of(f"{head}<article><p>text</p></article>") == blocks_of(f"{head}</head><body><article><p>text</p></article></body></html>")
    assert texts(f"{head}text of the page<p>more") == ["text of the page", "more"]
    assert texts(f"{head}<noscript><p>no script</p></noscript><script>x</script>\n<p>text") == ["text"]
    assert texts(f"{head}<p>one<body class=c><p>two") == ["one", "two"]
    assert texts("<body><div><svg><path d=x><text>drawn</text><p>one</p></div><p>two") == ["one", "two"]
    assert texts("<body><svg><text>drawn</text></svg><p>one<svg><foreignObject><div>drawn</div></foreignObject><text>drawn</text></svg> two") == ["one", "two"]
    assert texts("<body><div><noscript><p>one</div><p>two") == ["one", "two"]
    assert texts("<body><template><p>hidden</p></template><div><template><p>one</div><p>two") == ["one", "two"]


def plain_labels(net, page):
    """One page, one block and one direction at a time."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    p, h = {k: v.astype(np.float64) for k, v in net.p.items()}, P.HIDDEN
    f = P.Features([page])
    x = []
    for i in range(len(page)):
        path = p["path"][f.path[f.path_of == i]].sum(axis=0)
        words = p["word"][f.word[f.word_of == i]]
        x.append(np.concatenate([path, words.mean(axis=0) if len(words) else np.zeros(P.WORD_DIM), f.measures[i]]))
    states = {}
    for d, order in (("f", range(len(page))), ("b", range(len(page) - 1, -1, -1))):
        s, c = np.zeros(h), np.zeros(h)
        for t in order:
            a = x[t] @ p[f"w{d}"] + p[f"b{d}"] + s @ p[f"u{d}"]
            c = sig(a[h:2 * h]) * c + sig(a[:h]) * np.tanh(a[3 * h:])
            s = states[d, t] = sig(a[2 * h:3 * h]) * np.tanh(c)
    return [float(np.concatenate([states["f", t], states["b", t]]) @ p["out"] + p["out_b"][0]) for t in range(len(page))]


def test_labels_equal_a_plain_forward_pass(rows):
    plain, other = rows
    net = P.fit([h for h, _ in plain[:60]])
    pages = [blocks_of(h) for h, _ in plain[60:80] + other[:10]] + [[], [(("p",), "", 0)], [((), "x", 0)]]
    for page, got in zip(pages, net.label(pages)):
        want = plain_labels(net, page)
        assert len(got) == len(want) and all(g == (w > 0) or abs(w) < 1e-4 for g, w in zip(got, want))


def test_long_pages_are_learned_from(spark, monkeypatch):
    """Where every page has over 100,000 characters, the network is fitted to parts of them and labels other names too."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "the ver que ion st".split() for b in "er an os lich ment".split()]

    def page(main):
        text = [" ".join(rng.choices(words, k=rng.randrange(20, 60))) + "." for _ in range(500)]
        side = ["".join(f"<p>{' '.join(rng.choices(words, k=9))}</p>" for _ in range(5)) for _ in range(2)]
        body = "".join(f"<p>{t}</p>" for t in text)
        return f"<html><body><nav><ul><li><a href=x>one two</a></li></ul></nav><aside>{side[0]}</aside>{main[0]}{body}{main[1]}<footer>{side[1]}</footer></body></html>", "\n".join(text)

    monkeypatch.setattr(P, "FIT_BLOCKS", 60)
    made = [page(("<article>", "</article>")) for _ in range(30)]
    apart = [page(("<div class='content'>", "</div>")) for _ in range(4)]
    assert min(len(h) for h, _ in made + apart) > 100_000
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(made + apart)], "page_id long, url string, html string").repartition(4)
    assert P.sample_of(df).count() == 30 and all(40 < len(P.shown(blocks_of(h))) <= 60 for h, _ in made)
    got = {r["row"]["page_id"]: r["text"] for r in P.extracted(df).collect()}
    wrong = [len(set(got[i].split("\n")) ^ set(t.split("\n"))) for i, (_, t) in enumerate(made)]
    assert max(wrong) <= 2 and sum(wrong) < 10, wrong
    assert all(len(set(got[30 + i].split("\n")) ^ set(t.split("\n"))) < 10 for i, (_, t) in enumerate(apart))
