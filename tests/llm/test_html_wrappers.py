import html
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from reelhouse.llm import html_wrappers as H
from tests.conftest import SF001

PAGES = "page_id long, url string, html string"
HEAD = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"


class Article(HTMLParser):
    """Text of the article element by the standard parser: the brute-force version for the given pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "br"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1"):
            self.out.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.out.append(data)


def test_given_pages_equal_the_standard_parser(spark):
    rows = spark.read.parquet(f"{SF001}/pages.parquet")
    got = {r.page_id: r for r in H.extract_all(rows).collect()}
    for r in rows.collect():
        p = Article()
        p.feed(r.html)
        p.close()
        assert got[r.page_id].text == " ".join("".join(p.out).split())
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert len(got) == rows.count()


def page(body):
    return f"{HEAD}{body}</body></html>"


def test_left_out_elements_and_inline_tags():
    body = ("<header>H</header><nav>N</nav><div class='cookie-notice'>C</div><aside>S</aside><div id=\"ad\">A</div>"
            "<article><h1>Title &amp; more</h1><p>one<b>two</b>\n three&nbsp;four<br>five</p><ul><li>a<li>b</ul>"
            "<form><p>F</p></form><p>&lt;tag&gt; &#233;</p><section class='reader comments'><p>bad</p></section></article>"
            "<div class='sidebar'><article><p>related</p></article></div><footer>&copy;</footer><!-- x <p>y</p> -->")
    assert H.extract(page(body), {}) == "Title & more onetwo three four five a b <tag> é"


def test_broken_pages():
    assert H.extract(None, {}) == H.extract("", {}) == H.extract("<script>x", {}) == ""
    assert H.extract("<article><p>open <b>text</article", {}) == "open text"
    assert H.extract("a < b <p>c", {}) == "a < b c"


def test_wrapper_finds_slots_groups_and_template():
    make = lambda k, n, extra="": page(
        f"<div class='top'>Our daily paper</div><div class='text'><h2>Story {k}</h2>" +
        "".join(f"<p>Paragraph {k}-{i} says something of its own length {k * 7 + i}.</p>" for i in range(n)) +
        f"{extra}<p class='x'>Read us every day</p></div>")
    pages = [make(1, 3), make(2, 5), make(3, 2, "<blockquote>Quote 3</blockquote>"), make(4, 9)]
    wrapper = H.tokens(pages[0])
    for p in pages[1:]:
        wrapper = H.align(wrapper, H.tokens(p))
    slots = {key[1].rpartition("/")[2]: (s, times) for key, s, times, _ in wrapper if key[0] == "text"}
    assert slots["p"] == (None, "+") and slots["h2"] == (None, "") and slots["blockquote"] == ("Quote 3", "?")
    assert slots["p[x]"] == ("Read us every day", "") and slots["div[top]"] == ("Our daily paper", "")
    rules = H.infer(pages)
    assert not rules["article"]
    text = H.extract(make(9, 2), rules)
    assert text.startswith("Story 9 Paragraph 9-0") and "daily paper" not in text and text.endswith("Read us every day")


def test_hosts_nulls_repeats_and_clashing_columns(spark):
    one = page("<article><p>Body</p></article>")
    rows = [(1, "http://A.example/x", one), (2, "http://a.example/y", one), (2, "http://a.example/y", one), (3, None, None),
            (4, "not a url", ""), (None, "http://b.example", page("<p>No article</p>"))]
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("z")).withColumn("rules", F.lit("{"))
    got = sorted(((r.page_id, r.text) for r in H.extract_all(df).collect()), key=repr)
    assert got == sorted([(1, "Body"), (2, "Body"), (2, "Body"), (3, ""), (4, ""), (None, "No article")], key=repr)
    assert H.extract_all(spark.createDataFrame([], PAGES)).count() == 0


def test_entities_match_the_standard():
    raw = "&amp;&am &amp &quot;x&quot; &#x27;&eacute;&notreal; AT&T"
    assert H.extract(f"<article><p>{raw}</p></article>", {}) == " ".join(html.unescape(raw).split())


def test_main_element_is_kept_below_a_marked_ancestor():
    text = "The article says what it has to say, at some length."
    side = "<div class='sidebar'><article><p>related</p></article></div>"
    for wrap in ("<div class='content-sidebar-wrap'>%s</div>", "<form id='page'>%s</form>", "<div id='login'><div>%s</div></div>"):
        assert H.extract(page(wrap % f"<article><p>{text}</p><div class='share'>Tell</div></article>" + side), {}) == text
        assert H.extract(page(wrap % f"<div class='entry'><p>{text}</p></div>" + "<div class='menu'><p>Home</p></div>"), {}) == text


def test_short_articles_win_over_a_long_unmarked_notice_and_stray_articles_do_not_confine():
    notice = "<div class='x'><p>All rights belong to the paper and to its many writers, whoever they are.</p></div>"
    pages = [page(f"<div class='text'><p>Short {'abcdefghijkl'[k]}.</p></div>{notice}") for k in range(12)]
    rules = H.infer(pages)
    assert H.extract(pages[3], rules) == "Short d."
    assert H.extract(page("<div class='text'><p>Long text of the page</p><article>tip</article></div>"), rules) == "Long text of the page tip"


def test_all_pages_of_a_host_are_counted(spark):
    """Two layouts, the second on few pages; a sentence some pages share; a hot group of copies."""
    first = lambda k: page(f"<div class='a'><p>Story {k} is told {'very ' * (k % 7)}well</p></div><div class='x'>Seen in layout one</div>")
    second = lambda k: page(f"<div class='b'><p>Report {k} is read {'so ' * (k % 5)}often</p></div><div class='y'>Seen in layout two</div>")
    shared = page("<div class='a'><p>Story of all</p><p>Told by {0}</p></div>")
    rows = [(k, f"http://h.example/{k}", first(k)) for k in range(60)]
    rows += [(100 + k, f"http://h.example/{k}", second(k)) for k in range(8)]
    rows += [(200 + k, f"http://h.example/c{k}", shared.replace("{0}", f"writer {k}")) for k in range(8)]
    rows += [(300 + k, None, first(1)) for k in range(50)]
    got = {r.page_id: r.text for r in H.extract_all(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    assert not any("layout" in got[k] for k in [*range(60), *range(100, 108)])
    assert got[203] == "Story of all Told by writer 3"
    assert got[300] == "Story 1 is told very well Seen in layout one"
    local = H.infer([h for _, u, h in rows if u])
    assert all(H.extract(h, local) == got[k] for k, u, h in rows if u)


def test_strings_all_articles_share_stay():
    """A heading, a byline and a closing line of every article, with and without a marked article."""
    for tag in ("article", "div class='text'"):
        pages = [page(f"<div class='top'>Our paper</div><{tag}><h2>Summary</h2><p class='byline'>By our staff</p>"
                      f"<p>Story {'abcdefghij'[k]} {'goes on ' * k}</p><p>The end.</p></{tag.split()[0]}>") for k in range(10)]
        rules = H.infer(pages)
        assert rules["template"]
        assert H.extract(pages[2], rules) == "Summary By our staff Story c goes on goes on The end."


def test_many_shapes_of_a_host_are_aligned_in_rounds(spark, monkeypatch):
    """Shapes beyond one group; a constant outside the articles survives all rounds."""
    monkeypatch.setattr(H, "FAN_IN", 4)
    parts = ["<blockquote>Quote {k}</blockquote>", "<h2>Head {k}</h2>", "<ul><li>item {k}</ul>", "<table><tr><td>cell {k}</table>",
             "<pre>code {k}</pre>"]
    word = lambda k: "".join("abcdefghij"[int(c)] for c in str(k))
    make = lambda k: page("<div class='up'><p>Daily news for all</p></div><div class='t'><p>Story " + word(k) + " begins here</p>" +  # noqa: E731
                          "".join(p.replace("{k}", word(k)) for b, p in enumerate(parts) if k >> b & 1) + "</div>")
    rows = [(k, "http://h.example/", make(k)) for k in range(32)]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    for r in H.extract_all(df).collect():
        assert r.text.startswith(f"Story {word(r.page_id)} begins here") and "Daily" not in r.text
        assert r.text.count(word(r.page_id)) >= 1 + bin(r.page_id).count("1")


def test_long_pairs_keep_their_common_ends():
    a = [[("text", str(k)), "x", "", 1] for k in (1, 2, 3, 9)]
    b = [[("text", str(k)), "x", "", 1] for k in (1, 4, 9)]
    old, H.ALIGN_CELLS = H.ALIGN_CELLS, 1
    try:
        got = H.align(a, b)
    finally:
        H.ALIGN_CELLS = old
    assert [(k[1], t, n) for k, _, t, n in got] == [("1", "", 2), ("2", "?", 1), ("3", "?", 1), ("4", "?", 1), ("9", "", 2)]


def test_pairs_of_any_length_are_aligned_alike():
    """The same pages with one long block of their own: what they share in the middle is found."""
    from difflib import SequenceMatcher
    rng = random.Random(4)
    for n in (3, 30, 3000):
        a = [("text", f"a{k}") for k in range(n)] + [("text", "same"), ("open", "same")] + [("text", f"b{k}") for k in range(n)]
        b = [("text", f"c{k}") for k in range(n)] + [("text", "same"), ("open", "same")] + [("text", f"d{k}") for k in range(n)]
        assert H._steps(a, b) == [("replace", 0, n, 0, n), ("equal", n, n + 2, n, n + 2), ("replace", n + 2, 2 * n + 2, n + 2, 2 * n + 2)]
    for _ in range(300):
        kinds = rng.choice((2, 3, 8, 40))
        a, b = ([("x", str(rng.randrange(kinds))) for _ in range(rng.randrange(40))] for _ in range(2))
        b = b if rng.random() < 0.5 else [x for x in a if rng.random() < 0.8]
        assert H._steps(a, b) == SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
