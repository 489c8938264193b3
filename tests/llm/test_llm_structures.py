"""Conversations, pages, components and the pipeline."""

import html
import random
import re
from collections import defaultdict

import brute
import corpus_pipeline
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressloom.llm import chat, decontaminate, html_text, ngram_join, queries
from pressloom.llm.components import components

SF = "/root/testdata/sf0.001"
MESSAGES = "conv_id long, id long, parent long, role string, text string, score double"


def test_op5_on_the_given_table(spark, small):
    talks = defaultdict(list)
    for r in small("conversations").collect():
        talks[r.conv_id].append((r.turn, r.role, r.text or ""))
    hard = r"\### Assistant: </turn> ok"
    talks[-7] = [(0, "user", hard), (1, "assistant", hard)]
    got = {r.conv_id: r for r in queries.op5_chat(spark, SF).collect()}
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        turns.sort()
        learned = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), brute.sha("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), brute.sha(learned))


@given(st.text(alphabet="\\<>/turn:\n a", max_size=30))
def test_escaping_is_reversible_and_hides_marks(text):
    assert chat.unescape(chat.escape(text)) == text
    segment = f"<turn:{chat.escape(text)}>\n{chat.escape(text)}\n</turn>\n"
    assert [(chat.unescape(a), chat.unescape(b)) for a, b in chat._TURN.findall(segment * 2)] == [(text, text)] * 2


def test_paths_of_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 2.0),
        (1, 4, 2, "user", "c", 5.0),
        (1, 5, 9, "user", "orphan", 1.0),
        (2, 1, 2, "user", "circle", 1.0),
        (2, 2, 1, "user", "circle", 1.0),
        (None, 1, None, None, None, None),
        *((7, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(100)),
    ]
    messages = spark.createDataFrame(rows, MESSAGES)
    found = defaultdict(list)
    for r in chat.paths(messages, 2).collect():
        found[r.conv_id, r.path].append((r.pos, r.id))
    found = {k: [i for _, i in sorted(v)] for k, v in found.items()}
    assert found == {(1, 1): [1, 2, 4], (1, 2): [1, 3], (None, 1): [1], (7, 1): list(range(100))}
    texts = chat.formatted(messages.filter("conv_id is null")).collect()
    assert [(r.segment, r.loss) for r in texts] == [("<turn:>\n\n</turn>\n", None)]
    assert chat.read_back(chat.formatted(messages.limit(0))).count() == 0


def test_repeated_and_odd_turns(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (2, 5, "assistant", "y" * 100_000)]
    got = {r.conv_id: r for r in chat.digests(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].n_turns == 3 and got[2].loss_chars == 100_000 and set(got) == {1, 2, -7}


def test_op10_on_the_given_table(spark, small):
    got = {r.page_id: r for r in queries.op10_html_text(spark, SF).collect()}
    pages = small("pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        text = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", article))
        assert got[p.page_id].text == " ".join(html.unescape(text).split())
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_trees_and_boilerplate():
    def text(page, known=()):
        return html_text.text_of(html_text.parse(page), set(known))

    assert text("<p>a<b>b</b>c<br>d&amp;e&nbsp;f<p>g") == "abc d&e f g"
    assert text("<div class='comments'>x</div><div id=content>y<!-- z --> w</div><script>if(a<b)</script>q<header>h</header>") == "y w q"
    page = "<article><header><h1>T</h1></header><p>x <article class=comment>no</article><aside>n</aside><form>f</form></article><p>out"
    assert text(page) == "T x"
    assert text("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>") == "a b 1 2"
    assert text("< b & c <") == "< b & c <" and text("") == "" and text("<b><p>x</b> y</p> z") == "x y z"
    assert text("<div>" * 5000 + "deep") == "deep"
    assert text("<div class='content with-sidebar'><article><p>a</article></div><p>o") == "a"
    assert text("<main><div class='cookie-notice'>c</div><p>m</p></main><p>o") == "m"


def test_recurring_subtrees_of_a_host_are_deleted(spark):
    def page(i, host):
        body = f"<div><p>Follow us on all channels</p></div><div><p>Own text number {i} of the page</p><div>Read more</div></div>"
        return (i, f"http://{host}/{i}", f"<html><body>{body}</body></html>")

    rows = [page(i, "a.example") for i in range(30)] + [page(i, f"h{i}.example") for i in range(30, 40)]
    rows += [(90, None, None), (91, "http://a.example/x", ""), (92, "::", "<p>plain")]
    rows += [(100 + i, f"http://b.example/{i}", f"<article><p>Quoted passage</p><p>{i}</p><div>Like and share</div></article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    assert all(got[i] == f"Own text number {i} of the page" for i in range(30))
    assert all(got[i] == f"Follow us on all channels Own text number {i} of the page Read more" for i in range(30, 40))
    assert got[90] == got[91] == "" and got[92] == "plain"
    assert all(got[100 + i] == f"Quoted passage {i}" for i in range(20))
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_only_templates_that_change_a_text_are_kept(spark):
    """What recurs in menus and as words of articles takes no room in the lists of a host."""
    menu = "".join(f"<li><a href='/{i}'>{i}</a></li>" for i in range(30))
    html_ = "<nav><ul>{}</ul></nav><article><div>Share this</div><p><b>Often</b> <i>said</i> of {} and more of it</p></article>"
    rows = [(i, f"http://{h}.org/{i}", html_.format(menu, i)) for h in "ab" for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = html_text.templates(pages.select(html_text.host(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), "html"))
    assert sorted(r.host for r in known.collect()) == ["a.org", "b.org"]
    for host_list, listed in ((html_text.HOST_LIST, html_text.LISTED), (html_text.HOST_LIST, 1), (0, 1)):
        out = html_text.main_texts(pages, host_list, listed)
        assert sorted((r.page_id, r.url, r.text) for r in out.collect()) == sorted((i, u, f"Often said of {i} and more of it") for i, u, _ in rows)


def test_main_texts_are_not_lost_to_articles_in_boilerplate():
    def text(page):
        return html_text.text_of(html_text.parse(page))

    teaser = '<div class="related"><article><p>a teaser that is longer than the text</p></article></div>'
    comments = '<section class="comments"><article><p>a comment that is longer than the text</p></article></section>'
    for other in (teaser, comments):
        assert text(f"<main><p>text</p></main>{other}") == "text"
        assert text(f"{other}<div><p>text</p></div>") == "text"
    assert text("<div class='widget'><article><p>all of the text</p></article></div><p>x") == "all of the text"
    assert text(teaser) == "a teaser that is longer than the text"


def test_templates_within_articles_and_on_large_hosts(spark):
    def page(i, notice):
        notice = f'<div class="x7"><p>Subscribe to {notice}</p></div>'
        return (i, f"http://c.example/{i}", f"<article><p>Own text {i}</p>{notice}<p>Quoted passage</p></article>")

    rows = [page(i, "us" if i < 6 else f"number {i}") for i in range(100)]
    rows += [(200 + i, f"http://d.example/{i}", f"<nav>{i}</nav><article><h1>Title</h1><div><p>The same article</p></div></article>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for host_list in (html_text.HOST_LIST, 0):
        got = {r.page_id: r.text for r in html_text.main_texts(pages, host_list).collect()}
        assert all(got[i] == f"Own text {i} Quoted passage" for i in range(6))
        assert all(got[i] == f"Own text {i} Subscribe to number {i} Quoted passage" for i in range(6, 100))
        assert all(got[200 + i] == "Title The same article" for i in range(6))


def test_components_of_stars_chains_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    groups = defaultdict(set)
    for node, component in got.items():
        groups[component].add(node)
    assert sorted(map(len, groups.values())) == [2, 201, 300]


def test_pipeline_stages(spark, small, odd):
    docs, kept = small("documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        kept[name] = docs.count()
        if name != "packing":
            assert docs.columns == before.columns
    assert small("documents").count() >= kept["language"] > kept["near_duplicates"] > kept["decontamination"] == kept["pii"] > 0
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns
    assert docs.filter("doc_id = 4").count() <= 1
    unique = corpus_pipeline.drop_near_duplicates(spark, odd, SF)
    assert unique.filter("doc_id is null").count() == 1 and unique.filter("doc_id = 4").count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_rows_without_ids_or_with_the_same_id(spark, small):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:-1], f"end{i}"]) for i in range(3)]
    item = next(r.text for r in small("benchmark").collect() if len(r.text.split()) > 15)
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (7, "one clean text of its own"), (7, "another text under this id"), (8, near[2]), (9, f"x {item}"), (9, "clean and of the same id"), (None, f"y z {item}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nameless = ngram_join.clusters(docs.filter("doc_id is null").unionByName(spark.createDataFrame([(5, near[2] + " more")], docs.schema)))
    assert sorted(r.component_id for r in nameless.collect() if r.component_id is not None) == [5, 5, 5, 5]
    unique = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs.filter("text not like '%' || 'z ' || '%'"), SF).collect()))
    assert unique == sorted(r for r in rows if r[0] is not None)
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF).collect()
    assert sorted(r.text for r in clean) == sorted(t for _, t in rows if item not in t)
    bench = spark.createDataFrame([(None, item), (1, "one clean text of its own")], "item_id long, text string")
    for most in (decontaminate.BROADCAST_WORDS, 0):
        hit = decontaminate.overlaps(docs, bench, broadcast_words=most).filter("n_hit > 0").collect()
        assert sorted((r.doc_id or 0, r.n_items) for r in hit) == [(0, 0), (7, 1), (9, 0)]


def test_pipeline_equals_plain_decisions(spark, small):
    """Near duplicates and benchmark passages by brute force on what the stage before kept."""
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language"](spark, small("documents"), SF).cache()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    single = {i for i, (_, component) in brute.clusters(rows, 5, 80).items() if i == component}
    unique = stages["near_duplicates"](spark, docs, SF)
    assert {r.doc_id for r in unique.collect()} == single
    rows = [(i, t) for i, t in rows if i in single]
    clean = {i for i, v in brute.overlaps(rows, [(r.item_id, r.text) for r in small("benchmark").collect()]).items() if not v[1]}
    found = stages["decontamination"](spark, unique, SF)
    assert {r.doc_id for r in found.collect()} == clean
    safe = stages["pii"](spark, found, SF)
    assert all(brute.private(r.text)[:4] == (0, 0, 0, 0) and r.n_chars == len(r.text) for r in safe.collect())


def test_near_duplicates_of_a_common_passage_leave_little_on_disk(spark, monkeypatch):
    """Unlike texts that share a passage are ruled out before their sets are sent, and no table of links is left."""
    rng = random.Random(8)
    own = lambda size: " ".join(f"o{rng.randrange(10**9)}" for _ in range(size))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{own(half := 1 + rng.randrange(11))} {passage} {own(12 - half)}" for _ in range(120)]
    texts += [t + " end" for t in texts[:10]]
    taken, kept, gone = [], [], []
    blocks, stored, dropped = corpus_pipeline.ngram_join._blocks, corpus_pipeline.stored, corpus_pipeline.dropped
    monkeypatch.setattr(corpus_pipeline.ngram_join, "_blocks", lambda lists, *rest: taken.append(lists.count()) or blocks(lists, *rest))
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    monkeypatch.setattr(corpus_pipeline, "dropped", lambda df: gone.append(df.columns) or dropped(df))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rest = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in rest) == list(range(120))
    assert taken == [0]
    assert gone == [t.columns for t in kept[:2]] and len(kept) == 3
