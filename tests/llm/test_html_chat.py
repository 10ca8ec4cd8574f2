"""HTML extraction and quotation linking."""

import random
import time
import tracemalloc
from collections import Counter

from pyspark.sql import functions as F

from demandspark.llm.html_extract import DEEP, extract, host, main_text, parsed, style_tree
from demandspark.llm.quotations import linked_conversations, split_quotes

from tests.llm.data import SF

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="page"><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
<div class="sidebar"><p>side</p></div><div class="cookie-notice">We use cookies</div><article class="post"><h1>Title &amp; x</h1><p>One<br>two&nbsp;three <b>bold</b>.
<p>Second <a href="x>y">link</a> a < b &lt;i&gt;<ul><li>i1<li>i2</ul><div class="ad">Buy</div><section class="comments"><p>bad</p></section><table><tr><td>c1<td>c2</table>
<form><p>f</p></form><script>if (a<b) {"</p>"}</script><p>End</p></article><div id="comments"><article class="comment">no</article></div><!-- x > y --><p>outside</p><footer>&copy;</footer></body></html>"""


def test_article():
    assert main_text(parsed(PAGE)[0], set()) == "Title & x\nOne two three bold.\nSecond link a < b <i>\ni1\ni2\nc1\nc2\nEnd"


def test_pages_without_an_article():
    page = "<body><div class=menu>m</div><div class=content><p>a<p>b</div><div class=x9>boiler</div></body>"
    blocks = parsed(page)[0]
    assert main_text(blocks, set()) == "a\nb\nboiler"
    assert main_text(blocks, {"body/div.x"}) == "a\nb"
    assert main_text(blocks, {"body/div.x", "body/div.content"}) == "a\nb\nboiler"


def test_broken_markup():
    for page, expected in (("", ""), ("plain text", "plain text"), ("<p>a</b></div><p>b", "a\nb"), ("<p", "<p"), ("a<!-- open", "a"), ("<script>x", ""), ("<p class='a>b</p>", "b"), ("x &amp;amp; &#233; &bogus;", "x &amp; é &bogus;")):
        assert main_text(parsed(page)[0], set()) == expected, page


def test_attributes_and_names_count_as_a_whole():
    """Words of the noise list inside other attributes, their values, or longer class names tell nothing."""
    for link in ('href="/the-hidden-valley"', 'href="/item?id=login"', "href=/x?class=nav", 'data-id="search"', 'title="a role=menu"', 'data-hidden-by="x"', "title='style=display:none'"):
        assert main_text(parsed(f"<article><p>See <a {link}>this link</a> here.</p></article>")[0], set()) == "See this link here.", link
    assert main_text(parsed('<article><p data-note="hidden gem">a</p><p hidden>b</p><p STYLE="display: none">c</p><p id=login>d</p></article>')[0], set()) == "a"
    for name in ("content no-sidebar", "overflow-hidden", "has-menu", "hidden-xs", "search-results", "entry-header", "with_social x", "legal-history"):
        assert main_text(parsed(f'<body><div class="{name}"><p>x</p><article><p>a</p></article></div>')[0], set()) == "a", name
        assert main_text(parsed(f'<body><p>b</p><div class="{name}"><p>a</p></div>')[0], set()) == "b\na", name
    for name in ("sidebar", "x main-nav", "ad-300x250", "cookie_banner", "site-header", "post-comments", "related-posts", "share-buttons", "widget widget_text", "AD1"):
        assert main_text(parsed(f'<body><p>b</p><div class="{name}"><p>a</p></div>')[0], set()) == "b", name


def test_an_article_stands_out_of_a_wrapper():
    for wrapper in ('div class="sidebar"', 'form id="aspnetForm"', 'div class="hidden"', "header"):
        assert main_text(parsed(f'<body><{wrapper}><p>x</p><article><p>a</p><div class="ad">y</div></article></{wrapper.split()[0]}><p>z</p>')[0], set()) == "a", wrapper
    assert main_text(parsed('<main><p>a</p><div class="sidebar"><article>x</article></div></main>')[0], set()) == "a"
    for wrapper in ('div class="comments"', 'div id="ad"', "aside", 'div class="related-posts"'):
        assert main_text(parsed(f"<body><{wrapper}><article><p>x</p></article></{wrapper.split()[0]}><p>a</p>")[0], set()) == "a", wrapper
    assert main_text(parsed("<body><aside><p>x</p><article>a</article></aside>")[0], set()) == "a"
    assert main_text(parsed('<body><div class="comments"><article>x</article></div>')[0], set()) == ""


def test_embedded_elements():
    """Only scripts, styles and comments run to the end of the page; formulas keep their text."""
    for tag in ("math", "svg", "object", "select", "textarea", "iframe", "noscript", "template", "title"):
        assert main_text(parsed(f"<article><p>a</p><{tag}><p>b</p></article><p>x")[0], set()) == "a\nb", tag
        assert main_text(parsed(f"<article><div><{tag}></div><p>b <i>c</i></p></article><{tag}></{tag}>")[0], set()) == "b c", tag
    for tag in ("select", "textarea", "iframe", "noscript", "template", "title"):
        assert main_text(parsed(f"<article><p>a</p><{tag}>x<option>y</option></{tag}><p>b</p></article>")[0], set()) == "a\nb", tag
    for page, expected in (("<p>If <math display=inline><semantics><mrow><mi>x</mi> <mo>&lt;</mo> <mn>2</mn></mrow><annotation encoding=tex>x \\lt 2</annotation></semantics></math> then", "If x < 2 then"),
                           ("<p>a <svg viewBox='0 0 1 1'><title>icon</title><desc>long</desc><path d='M0 0'/></svg> b<p>c", "a b\nc"), ("<p>a <object data=x>seen <b>here</b></object> b", "a seen here b"),
                           ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math>", "1 2"), ("<head><title>T<body><p>a", "a"), ("<html><head><title>a < b <i>T</i></title></head><body><p>a", "a"),
                           ("<p>a<select><option>x<option>y<p>b", "a\nb"), ("<template><template>x</template><p>y</p></template>a", "a"), ("a<script>x<p>y", "a"), ("a<style>x<p>y", "a")):
        assert main_text(parsed(page)[0], set()) == expected, page


def test_quotes_open_strings_only_after_an_equals_sign():
    for page, expected in (("<p title=don't>Story</p><p>it's long</p><p>End</p>", "Story\nit's long\nEnd"), ("a<!-->b<!--->c<!-- x -->d<!-- y --!>e", "abcde"), ("<p a=\"x>y\" b='>' c = d e=>z</p>", "z"),
                           ('<p>a <a href=/x?q="y">l</a> "k"</p>', 'a l "k"'), ("<p'>a</p><p \">b</p>", "a\nb"), ("<p a = 'x' b>it's</p>", "it's"), ("<p a='x'b=\"y\">c</p>", "c"), ("<p =x>a</p>", "a")):
        assert main_text(parsed(page)[0], set()) == expected, page


def test_deep_nesting_is_linear():
    """A megabyte of unclosed elements, and texts below the deepest path."""
    for unit in ("<div>", "<div>ab ", "<div></section>", "<blockquote><p>", "<template>", "<select>", "<form><article>", "<h1><li>"):
        began = time.process_time()
        tracemalloc.start()
        blocks, nodes = parsed(unit * ((1 << 18) // len(unit)))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert time.process_time() - began < 20 and most < 125 << 20, unit
        assert len({p for p, _ in nodes}) <= 2 * DEEP + 2 and max(p.count("/") for p, _ in nodes) <= DEEP
    assert main_text(parsed("<div>" * 500 + "a" + "<div class=ad>x</div><p>b" + "</div>" * 500 + "c")[0], set()) == "a\nb\nc"


def test_hosts():
    assert [host(u) for u in ("https://u:p@A.example.com:80/x", "http://b.org", None, "nothing")] == ["a.example.com", "b.org", "", ""]


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = extract(pages).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) and r.text for r in rows)
    import html
    import re

    for r in pages.join(extract(pages).select("page_id", "text"), "page_id").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(x for x in parts if x)


def test_branches_that_a_host_repeats_are_removed(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div class=top>Always the same</div><div class=text><p>Story {i} {i * 7}</p></div><div class=low>Call {1 if i % 9 else 2}</div></body>", "x") for i in range(30)]
    rows += [(100, "http://one.org", "<body><div class=top>Always the same</div></body>", "x"), (101, None, None, None), (None, "http://h.org/", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert all(got[i] == f"Story {i} {i * 7}" for i in range(30))
    assert got[100] == "Always the same" and got[101] == "" and got[None] == ""
    tree = {r.path: r for r in style_tree(pages).where("host = 'h.org'").collect()}
    assert tree["body/div.top"].importance < 0.5 < tree["body/div.text/p"].importance and tree["body/div.text"].pages == 30
    assert extract(pages.limit(0)).count() == 0


def test_measurement_decides_about_articles(spark):
    """Boilerplate inside an article falls, main text beside teaser articles stays; few pages keep what elements tell."""

    def inside(k):
        return f"<body><article><h1>News {k * 13}</h1><div class=box><p>Read our <b>guide</b></p></div><p>Story {k} {k * 7}</p><p>More {k}</p></article><div class=low>Same</div><div class=ad>Buy {k}</div></body>"

    def beside(k):
        return f"<body><article class=card><p>Teaser</p></article><div class=text><p>Story {k}</p><p>End {k * 3}</p></div><article class=card><p>Other</p></article><div class=low>Same</div><div class=comments><p>I think {k}</p></div></body>"

    rows = [(k, f"http://in.org/{k}", inside(k)) for k in range(20)] + [(100 + k, f"http://by.org/{k}", beside(k)) for k in range(20)]
    rows += [(200 + k, f"http://few.org/{k}", inside(k)) for k in range(3)] + [(300 + k, f"http://less.org/{k}", beside(k)) for k in range(3)]
    rows += [(400 + k, f"http://one.org/{k}", "<body><article><p>One</p></article><p>x</p></body>") for k in range(9)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(20):
        assert got[k] == f"News {k * 13}\nStory {k} {k * 7}\nMore {k}" and got[100 + k] == f"Story {k}\nEnd {k * 3}"
    for k in range(3):
        assert got[200 + k] == f"News {k * 13}\nRead our guide\nStory {k} {k * 7}\nMore {k}" and got[300 + k] == "Teaser\nOther"
    assert all(got[400 + k] == "One" for k in range(9))


def test_much_boilerplate_does_not_take_the_text_along(spark):
    rows = [(k, f"http://m.org/{k}", "<body>" + "".join(f"<div class=b{'x' * n}>Same {n}</div>" for n in range(40)) + f"<div class=text><p>Story {k}</p></div></body>") for k in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract(pages).collect()} == {k: f"Story {k}" for k in range(5)}


def test_quotes():
    own, passages = split_quotes("Hi\n\nOn Monday X wrote:\n> a b\n> c\n>> deeper\nmine\n > again")
    assert own == "Hi\nmine" and passages == [(1, "a b c"), (2, "deeper"), (1, "again")]
    assert split_quotes("a > b\nx wrote:") == ("a > b\nx wrote:", [])


def test_linked_conversations(spark):
    rows = [(1, 0, "user", "Hello there my friend. How are you today?"), (1, 1, "assistant", "I am fine thanks. What about you?"), (1, 2, "user", "On Monday X wrote:\n> How are you\n> today?\nAgain: how are you."),
            (1, 3, "assistant", "> > How are you today?\n> Again: how are you.\nOk fine."), (1, 4, "user", "> I am fine thanks.\nGood."), (2, 0, "user", "a"), (2, 1, None, None), (2, 2, "user", "> unknown thing\nb"),
            (None, 0, "user", "q"), (3, 5, "u", "z"), (3, 5, "u", "z"), (3, None, "u", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, place string")
    got = linked_conversations(df)
    one = [(r.place, r.depth, r.turn, r.reply_to, r.text) for r in got.where("conv_id = 1").orderBy("place").collect()]
    assert one == [(1, 0, 0, None, "Hello there my friend. How are you today?"), (2, 1, 1, 0, "I am fine thanks. What about you?"), (3, 2, 4, 1, "Good."), (4, 1, 2, 0, "Again: how are you."), (5, 2, 3, 2, "Ok fine.")]
    assert [(r.place, r.turn, r.reply_to, r.text) for r in got.where("conv_id = 2").orderBy("place").collect()] == [(1, 0, None, "a"), (2, 1, 0, ""), (3, 2, 1, "b")]
    assert got.count() == len(rows) and got.where("conv_id = 3").agg(F.countDistinct("place")).first()[0] == 3
    assert linked_conversations(df.limit(0)).count() == 0


def brute_order(to):
    children = {}
    for seq, parent in to.items():
        children.setdefault(parent, []).append(seq)
    out = []

    def walk(seq):
        out.append(seq)
        for c in sorted(children.get(seq, [])):
            walk(c)

    walk(1)
    return {seq: i for i, seq in enumerate(out, 1)}


def test_reply_places_of_a_random_tree(spark):
    import random

    from demandspark.llm.quotations import reply_places

    rng = random.Random(6)
    to = {seq: rng.randint(max(1, seq - 6), seq - 1) if seq > 1 else 0 for seq in range(1, 90)}
    tree = spark.createDataFrame([(5, s, p) for s, p in to.items()], "conv long, seq long, to long")
    assert {r.seq: r.place for r in reply_places(tree).collect()} == brute_order(to)


def brute_parents(texts):
    """Each message's parent by number, straight from the rules; messages are numbered from 1."""
    from demandspark.llm.quotations import sentences

    own, quoted = [], []
    for text in texts:
        clean, passages = split_quotes(text or "")
        own.append({h for h, _ in sentences(clean)})
        quoted.append([(d, h, n) for d, p in passages for h, n in sentences(p)])
    parents = {}
    lost = {}
    for i, asks in enumerate(quoted):
        exact, deep = {}, {}
        for d, h, n in asks:
            has = [j for j in range(i) if (h in own[j] if d == 1 else any(e == d - 1 and g == h for e, g, _ in quoted[j]))]
            if has:
                exact.setdefault(d, Counter())[has[-1]] += n
            has = [j for j in range(i) if h in own[j]]
            if d > 1 and has:
                deep.setdefault(d, Counter())[has[-1]] += n
        for found, out in ((exact, parents), (deep, lost)):
            if found:
                level = found[min(found)]
                out[i] = max(level, key=lambda j: (level[j], j))
    for i, author in lost.items():
        if i not in parents:
            before = [j for j in range(i) if j not in lost or j in parents]
            replies = [j for j in before if j and parents.get(j, j - 1) == author]
            lost[i] = max(replies, default=author)
    return [parents.get(i, lost.get(i, i - 1)) + 1 if i else 0 for i in range(len(texts))]


def test_quotations_of_all_levels(spark):
    rng = random.Random(11)
    said = [f"Sentence number {k} says {k * 37 % 101}." for k in range(40)]
    talks = [["One thing.", "Other thing.", "Third.", ">> One thing.\nI see"], ["a one.", "> a one.\nb two.", "c three.", ">> a one.\n> b two.\nd", ">> a one.\nonly deep", ">>> a one.\ndeeper"],
             ["Q here.", "no quote", "> Q here.\nyes", ">> Q here.\n", ">> unknown\nx", ">> Q here.\n> no quote\ny"]]
    for _ in range(60):
        talk = []
        for i in range(rng.randint(2, 9)):
            lines = []
            for _ in range(rng.randint(0, 3)):
                if talk:
                    lines += [f"{'>' * rng.randint(1, 3)} {rng.choice(said[:8])}"]
            talk.append("\n".join([*lines, rng.choice(said[:8]) if rng.random() < 0.8 else rng.choice(said)]))
        talks.append(talk)
    rows = [(c, t, "user", text) for c, talk in enumerate(talks) for t, text in enumerate(talk, 1)]
    got = {(r.conv_id, r.turn): r.reply_to or 0 for r in linked_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: got[k] for k in got} == {(c, t): p for c, talk in enumerate(talks) for t, p in enumerate(brute_parents(talk), 1)}
    assert got[1, 4] == 2 and got[1, 5] == 2 and got[1, 6] == 5 and got[2, 4] == 3
