import numpy as np
import pytest

from ledgerlake.llm import webpages as k
from ledgerlake.llm.queries import QUERIES


def test_blocks():
    page = (
        '<html><head><title>No</title><style>p{}</style></head><body class="a b" id=main><script>var t="</p>";</script>'
        '<p>One &amp; <b>two\n three<br>four<p>Five<!-- no <p> --></p><ul><li>x<li>y</ul><a href="#" title="a > b">link</a> tail <img src=x>'
        "<p>&lt;not a tag&gt; 1 < 2</p><p>cut off"
    )
    got = k.blocks(page)
    assert [b.text for b in got] == ["One & two three four", "Five", "x", "y", "link tail", "<not a tag> 1 < 2", "cut off"]
    assert got[0].path[:6] == ("html", "/", "body", ".a", ".b", "#main")
    assert got[2].path[-4:] == ("ul", "/", "li", "/") and got[4].linked == 4
    assert k.blocks("") == [] and [b.text for b in k.blocks("plain")] == ["plain"]
    assert [b.text for b in k.blocks("a <b c='<i>' d=\"e\">f</b> <i g")] == ["a f"]


@pytest.mark.parametrize("before", [
    "<svg-icon></svg-icon>", "<button-group></button-group>", "<title-card></title-card>", "<template-part></template-part>",
    "<select-box></select-box>", '<svg class="x" />', "<math/>", "<object/>", "<title/>", '<script src="x" />',
    "<datalist><option value=A>A<option>B</datalist>", "<select><option>A<option>B</select>", "<select><option>A", "<option>A",
    "<button>", "<noscript>", "<object>", "<nav><button></nav>", "<svg><title>A</title><svg></svg><text>B</text></svg>",
    "<button><div>A</div></button>", "<noscript><p>A</noscript>", '<script data-x="a>b">A</script >', "<style>p{}</STYLE\n>",
    "<button><button>A</button>", "<template><table><tr><td>A</table></template>", "<iframe>A</iframe>",
])
def test_elements_left_out_end_where_they_end(before):
    page = f"<body>{before}<article><p>One</p><p>Two <button>no</button> three</p></article><button>B</button></body>"
    assert [b.text for b in k.blocks(page)] == ["One", "Two", "three"]
    assert all(k.is_text(b.path) for b in k.blocks(page))


@pytest.mark.parametrize("tag", ["script", "style", "textarea", "title"])
def test_raw_elements_run_to_the_end(tag):
    assert [b.text for b in k.blocks(f"<p>One</p><{tag}>no <p>no</p>")] == ["One"]


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    vectors = [rng.normal(size=(n, 5)).astype(np.float64) for n in (4, 2)]
    labels = [rng.integers(0, 2, 4), rng.integers(0, 2, 2)]
    net = k.new_net(5, 3, 1)
    wx, wh = [w.astype(np.float64) for w in net.wx], [w.astype(np.float64) for w in net.wh]

    def loss():
        p = k.probabilities(k.Net([w.astype(np.float32) for w in wx], [w.astype(np.float32) for w in wh], net.out), vectors)
        return -sum(np.log(np.where(y == 1, q, 1 - q)).sum() for q, y in zip(p, labels))

    x, back, lengths, active = k.padded([v.astype(np.float32) for v in vectors])
    ahead, kept = k.run_direction(net.wx[0], net.wh[0], x, active, True)
    behind, kept1 = k.run_direction(net.wx[1], net.wh[1], back, active, True)
    both = np.concatenate([ahead, k.unreversed(behind, lengths)], axis=2)
    p = 1 / (1 + np.exp(-(both @ net.out[:-1] + net.out[-1])))
    err = np.zeros_like(p)
    for j in range(2):
        err[: lengths[j], j] = p[: lengths[j], j] - labels[j]
    d = err[:, :, None] * net.out[:-1]
    dwx, dwh = k.gradient(net.wh[0], x, active, kept, d[:, :, :3])
    dwx1, dwh1 = k.gradient(net.wh[1], back, active, kept1, k.unreversed(d[:, :, 3:], lengths))
    for params, grad in ((wx[0], dwx), (wh[0], dwh), (wx[1], dwx1), (wh[1], dwh1)):
        for at in [(0, 0), (1, 4), (2, 7), (0, 11)]:
            params[at] += 1e-2
            up = loss()
            params[at] -= 2e-2
            down = loss()
            params[at] += 1e-2
            assert (up - down) / 2e-2 == pytest.approx(grad[at], abs=2e-2)


def test_pages_of_the_table(spark, sf):
    rows = QUERIES["op7_main_text"](spark, sf).collect()
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        want = "\n".join(b.text for b in k.blocks(html[r["page_id"]]) if k.is_text(b.path))
        assert r["text"] == want and r["n_chars"] == len(want) > 0


def test_other_layouts(spark, sf):
    pages = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    net = k.fit_pages(pages[:40])
    rng = np.random.default_rng(8)
    wrong = total = 0
    for page in pages[40:]:
        found = k.blocks(page)
        text, other = [b.text for b in found if k.is_text(b.path)], [b.text for b in found if not k.is_text(b.path)]
        for _ in range(5):
            made, labels = k.laid_out_anew(text[:15], other, rng)
            again = k.blocks(made)
            if len(again) == len(labels):
                p = k.probabilities(net, k.features([again], {}))[0]
                wrong += int(((p >= 0.5) != np.array(labels)).sum())
                total += len(labels)
    assert total > 300 and wrong / total < 0.03


# Pages written by hand, with the text that a reader would take from them.
PAGES = [
    (
        """<html><head><title>Site</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>
<div class="ad">Buy the new chair today.</div><article><h1>Rain over the hills</h1><p>The rain came in the morning, and it stayed
all day.</p><div class="ad">Cheap umbrellas, only this week.</div><p>People in the valley said that they had seen
worse&nbsp;&mdash; much worse.</p><section class="comments"><p>I was there, it was wet.</p><p>Nice photos!</p></section></article>
<footer><p>All rights reserved.</p></footer></body></html>""",
        "Rain over the hills\nThe rain came in the morning, and it stayed all day.\nPeople in the valley said that they had seen worse \u2014 much worse.",
    ),
    (
        """<html><body><header class="site-header"><a href=/>Daily</a> <a href=/s>Sport</a></header><main><article class="story"><h2>A long match</h2>
<div class="cookie-notice"><p>We use cookies, please agree to them.</p></div><p>The match went on for five hours, with two breaks.</p>
<blockquote>We never gave up, said the captain.</blockquote><p>The next one is on Sunday.</p><div id="comments"><div class="comment">First!</div>
<div class="comment">What a match, well played by both.</div></div></article></main><aside><p>Read this too: the best ten matches.</p></aside></body></html>""",
        "A long match\nThe match went on for five hours, with two breaks.\nWe never gave up, said the captain.\nThe next one is on Sunday.",
    ),
    (
        """<!DOCTYPE html><html><body><nav><a href=/a>One</a><a href=/b>Two</a></nav><article><h1>Bread &amp; salt</h1><p>Take flour, water and
salt; mix them well.<p>Let the dough rest, then bake it for an hour.<div class="newsletter subscribe"><p>Get our letter every week.</p></div>
<p>It keeps for three days.</article><form class="search"><p>Search the site</p></form><footer>About us. Imprint.</footer></body></html>""",
        "Bread & salt\nTake flour, water and salt; mix them well.\nLet the dough rest, then bake it for an hour.\nIt keeps for three days.",
    ),
]


def test_pages_written_by_hand(spark, sf):
    net = k.train(spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/pages.parquet"))
    for page, want in PAGES:
        assert "\n".join(b.text for b in k.blocks(page) if k.is_text(b.path)) == want
        assert k.extract(net, [page], {}) == [want]


@pytest.mark.parametrize("part", ['<div class="ad">x y</div>', '<section class="comments"><p>x y</p></section>', '<p id="cookie-notice">x y</p>'])
def test_named_parts_are_not_taught_as_text(part):
    found = k.blocks(f"<article><p>a b</p>{part}<p>c d</p></article>")
    assert [b.text for b in found if k.is_text(b.path)] == ["a b", "c d"] and len(found) == 3


def test_odd_rows(spark, frame):
    rows = [(1, None), (2, ""), (2, ""), (None, "<article><p>a</p></article>" * 2), (3, "<p>" * 3000 + "deep"), (4, "<article>" + "<p>w x y</p>" * 5000)]
    pages = frame(rows, ("page_id", "html"))
    got = {r["page_id"]: r["text"] for r in k.main_text(pages, k.train(pages), out="main").withColumnRenamed("main", "text").collect()} \
        if "text" not in pages.columns else {}
    assert got[1] == "" and got[2] == "" and got[None] == "a\na" and got[4].count("\n") == 4999
    assert k.main_text(frame([], ("page_id", "html")), None).count() == 0
    assert k.train(frame([], ("page_id", "html"))) is None
