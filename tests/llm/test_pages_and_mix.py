"""Source mixing, page text, url rules and the pipeline."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronoloom.llm import mixing, urls, wrappers
from chronoloom.llm.queries import QUERIES, URL_RULES

DOCS = "doc_id long, text string, source string, size string, target string, copies string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "a", "b", "c") for i, t, s in rows], DOCS)


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    out, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def check_mix(rows, texts):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (t, _) in texts.items()}
    sources = defaultdict(int)
    for i, (_, s) in texts.items():
        sources[s] += size[i]
    targets, taken, largest = targets_by_hand(dict(sources)), defaultdict(int), defaultdict(int)
    assert len(rows) == len(texts)
    for r in rows:
        source = texts[r.doc_id][1]
        assert r.size == size[r.doc_id] and r.source_size == sources[source]
        assert r.target == pytest.approx(targets[source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(largest[s], 0.01 * target)
    return targets


def test_mix_of_the_tables(spark, sf_dir):
    texts = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()}
    rows = QUERIES["op5_source_mix"](spark, sf_dir).collect()
    check_mix(rows, texts)
    assert sorted(rows) == sorted(QUERIES["op5_source_mix"](spark, sf_dir).collect())


def test_mix_balances_in_relative_entropy(spark):
    """Rates follow exp(tilt * size) with one tilt a source, up to the most repeats."""
    draw = np.random.default_rng(1)
    texts = {i: (" ".join(["w"] * int(draw.integers(0, 60))), f"s{i % 2}") for i in range(300)} | {300: (None, None), 301: ("a b", None), 302: ("a", "")}
    rows = mixing.mix_sources(docs_of(spark, [(i, t, s) for i, (t, s) in texts.items()])).collect()
    targets = check_mix(rows, texts)
    for source in ("s0", "s1"):
        own = [r for r in rows if r.source == source and r.size]
        assert sum(r.rate * r.size for r in own) == pytest.approx(targets[source], rel=1e-4)
        tilt = [np.log(r.rate) / r.size for r in own if r.rate < 2.999]
        assert np.ptp(tilt) < 1e-9


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x", None), (None, "y y", "a"), (4, "z " * 50_000, "b"), (4, "z " * 50_000, "b"), (5, "q", "é"), (6, None, "empty")]
    docs = docs_of(spark, rows)
    got = mixing.mix_sources(docs).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter([(1, 0), (2, 0), (3, 1), (None, 2), (4, 50_000), (4, 50_000), (5, 1), (6, 0)])
    assert all(r.taken <= 3 * r.size for r in got)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == sum((Counter({r.doc_id: r.copies}) for r in got), Counter())
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix_sources(docs.where("text is null")).collect()} == {0}


def test_rules_by_brute_force(spark, sf_dir):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    pages = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op9_url_filter"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        rest = (pages[r.page_id] or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [x for x in rules if (host == x.partition("/")[0] or host.endswith("." + x.partition("/")[0])) and path.startswith("/" + x.partition("/")[2])]
        rule = max(fits, key=len, default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, rules.get(rule, "allow"))


def page(head="", body=""):
    return f"<html><head>{head}</head><body>{body}</body></html>"


def test_aliases_share_decisions(spark):
    link = lambda u: page(f'<link href="{u}" rel=canonical>')
    jump = lambda u: page(f'<META HTTP-EQUIV="Refresh" content="0; url=\'{u}\'">')
    rows = [
        (1, "http://a.org/x", link("https://spam.net/1")),
        (2, "http://b.org/y", jump("//a.org/x")),
        (3, "http://c.org/z?q=1#f", link("http://b.org/y#top")),
        (4, "https://spam.net/1", None),
        (5, "http://d.org/fr/k", link("https://spam.net/1?other")),
        (6, "https://spam.net/1?other", ""),
        (7, "http://e.org/k", jump("http://d.org/fr/k")),
        (8, "http://f.org/dir/one", link("two")),
        (9, "http://f.org/dir/two", link("/three")),
        (10, "http://f.org/three", jump("http://evil.NET/")),
        (11, "http://g.org/", page("", '<p>&lt;link rel="canonical" href="http://evil.net/"&gt;</p><link rel="canonical" href="http://evil.net/">')),
        (12, "http://h.org/", page('<!-- <link rel="canonical" href="http://evil.net/"> -->')),
        (13, None, link("http://evil.net/")),
        (14, "no address", link("http://evil.net/")),
        (15, "http://i.org/", link("mailto:x@evil.net")),
        (1, "http://a.org/x", link("https://spam.net/1")),
        (16, "HTTP://Evil.Net", None),
        (17, "http://example.net/en/ok", link("http://evil.net/")),
    ]
    frame = spark.createDataFrame([(*r, "clash", "n") for r in rows], "page_id long, url string, html string, host string, node string")
    got = urls.judge_urls(frame, URL_RULES).collect()
    assert len(got) == len(rows)
    verdict = {r.page_id: r.verdict for r in got}
    blocked = {1, 2, 3, 4, 6}
    # evil.net/ is an alias of an allowed page too (17), and an allow among aliases comes first; its own pages keep their own rule.
    assert {k for k, v in verdict.items() if v == "block"} == blocked
    assert verdict[5] == verdict[7] == "allow" and verdict[17] == "allow"
    assert {r.alias_root for r in got if r.page_id in (1, 2, 3, 4)} != {None} and len({r.alias_root for r in got if r.page_id in (1, 2, 3, 4)}) == 1
    assert [(r.host, r.path, r.rule) for r in got if r.page_id in (13, 14)] == [("", "", None)] * 2
    assert [(r.host, r.path, r.rule, r.verdict) for r in got if r.page_id == 16] == [("evil.net", "", None, "allow")]
    without = urls.judge_urls(frame.where("page_id <> 17"), URL_RULES).collect()
    assert {r.page_id for r in without if r.verdict == "block"} == blocked | {8, 9, 10, 16}
    logged = spark.createDataFrame([("http://h.org/", "http://spam.net/log")], "a string, b string")
    assert {r.page_id for r in urls.judge_urls(frame, URL_RULES, logged).collect() if r.verdict == "block"} == blocked | {12}
    assert urls.judge_urls(frame.limit(0), URL_RULES).count() == 0


def test_page_text_by_brute_force(spark, sf_dir):
    pages = {r[0]: r[2] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()}
    rows = QUERIES["op8_html_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_page_text_without_articles(spark):
    """Hosts without article elements: the group whose paragraphs hold the most text."""
    shell = '<div id="menu-7"><a href=/>Home</a></div><div class="post-body">{}</div><div class="sidebar"><p>{}</p></div><div class=comments><p>nice</p></div><p class="cookie-notice">ok?</p>'
    rows = [(i, f"http://h.org/{i}", page("<title>t</title>", shell.format("".join(f"<p>Par {i} {k} &lt;b&gt; text" for k in range(i + 1)), "other " * 3))) for i in range(6)]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "\n\n".join(f"Par {i} {k} <b> text" for k in range(i + 1)) for i in range(6)}


def test_wrappers_align_tokens():
    one = wrappers.fold(wrappers.parse("<div><h1>a</h1><p>b</p><p>c</p></div>"))
    two = wrappers.fold(wrappers.parse("<div><p>longer</p><hr></div>"))
    both = wrappers.merge(one, two).children[0]
    assert [(c.label, c.optional, c.repeated) for c in both.children] == [("h1", True, False), ("p", False, True), ("hr", True, False)]
    packed = wrappers.Node.unpacked(both.packed())
    assert packed.packed() == both.packed()
    assert wrappers.align(list("abcxd"), list("abyxzd")) == [(0, 0), (1, 1), (3, 3), (4, 5)]


def test_page_text_of_odd_rows(spark):
    rows = [
        (1, None, None),
        (2, "", ""),
        (3, "http://a.org/", "plain text only & more"),
        (4, "http://a.org/", "<article>x<div class='comments'>c</div> y<form>z</form><script>var a='</p>'</script></article><footer>f"),
        (5, None, "<ul><li>a<li>b</ul>t < 5 <b"),
        (6, "http://b.org/", "<article>" + "<p>w" * 20_000 + "</article>"),
        (6, "http://b.org/", "<article><p>w</article>"),
        (7, "http://c.org/", "<main><article><header><h1>T</h1></header><p>q&nbsp;\n r&eacute;</p><aside>no</aside></article></main>"),
        (8, "http://d.org/", "</p></div><<<>><p title=\"unclosed>"),
    ]
    frame = spark.createDataFrame([(*r, "h", "w") for r in rows], "page_id long, url string, html string, host string, wrapper string")
    got = [(r.page_id, r.text, r.n_chars) for r in wrappers.extract_pages(frame).collect()]
    texts = Counter(t for _, t, _ in got)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    by = dict((i, t) for i, t, _ in got if i != 6)
    assert by[1] == by[2] == "" and by[3] == "plain text only & more" and by[4] == "x\n\ny" and by[5] == "a\n\nb\n\nt < 5" and by[7] == "T\n\nq ré"
    assert texts["\n\n".join(["w"] * 20_000)] == texts["w"] == 1
    assert wrappers.extract_pages(frame.limit(0)).count() == 0


def test_pipeline_stages(spark, sf_dir):
    """Each stage on what the one before kept, against brute force."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for number, (_, stage) in enumerate(pipeline.STAGES):
        path = pipeline.scratch_path(spark, f"test-pipeline-{number}")
        stage(spark, kept[-1], sf_dir).write.parquet(path)
        kept.append(spark.read.parquet(path))
    tables = [f.collect() for f in kept]
    assert all(f.columns == docs.columns for f in kept[:-1])
    bad = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    left = {r.doc_id for r in tables[1]}
    assert len(bad - left) > 0.8 * len(bad) and len(good & left) > 0.9 * len(good)

    first = {}
    for r in sorted(tables[1], key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    assert sorted(r.doc_id for r in tables[2]) == sorted(first.values())

    from test_duplicates import linked_by_force, shingle_sets

    linked = linked_by_force(shingle_sets([(r.doc_id, r.text) for r in tables[2]]))
    assert sorted(r.doc_id for r in tables[3]) == sorted(i for i, (_, c) in linked.items() if c == i)

    texts = {r.doc_id: (r.text, r.source) for r in tables[3]}
    copies = Counter(r.doc_id for r in tables[4])
    check_mix([r for r in mixing.mix_sources(kept[3]).collect()], texts)
    assert copies == Counter({r.doc_id: r.copies for r in mixing.mix_sources(kept[3]).collect() if r.copies})
    assert Counter(r.doc_id for r in tables[5]) == copies and all(len(r.ids) == r.n_tokens for r in tables[5])
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect())) == sorted((r.doc_id, r.n_tokens) for r in tables[5])


def _plain_page(k: int, extra: str = "") -> str:
    body = "".join(f"<p>Paragraph {k}-{i} tells of matter {k * 7 + i} at some length, as paragraphs do.</p>" for i in range(2 + k % 3))
    return (
        "<html><body><div class='wrap'><div class='strap'>The Example Gazette has been printed daily in this town since the year 1901, for all who read.</div>"
        f"<div class='lead'>Lead of story {k}, told in one line.</div><div class='copy'><h2>Story {k}</h2><div class='stamp'>Reprinted by kind permission of the Example Gazette and its owners.</div>"
        f"{body}</div>{extra}<div class='fine'>Terms of the Example Gazette apply to this and every other page, wherever it is read.</div></div></body></html>"
    )


def test_slots_of_a_host_without_articles(spark):
    """What all pages of a host say is no main text, though its place and its class words do not tell; a page read alone cannot know."""
    rows = [(k, f"http://gazette.example/{k}", _plain_page(k)) for k in range(7)]
    rows.append((50, "http://lone.example/1", _plain_page(50)))
    rows += [(60 + k, f"http://same.example/{k}", _plain_page(60)) for k in range(4)]  # copies: nothing differs, so nothing is told apart
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(7):
        paragraphs = [f"Paragraph {k}-{i} tells of matter {k * 7 + i} at some length, as paragraphs do." for i in range(2 + k % 3)]
        assert got[k] == "\n\n".join([f"Lead of story {k}, told in one line.", f"Story {k}", *paragraphs])
        assert wrappers.main_text(_plain_page(k), None) != got[k]
    for k in (50, 60, 61, 62, 63):
        story = min(k, 60)
        assert f"Lead of story {story}" in got[k] and f"Paragraph {story}-0" in got[k]
    assert "Reprinted" in got[50] and "Reprinted" in got[60]


def test_optional_groups_beside_the_main_one(spark):
    """A group that few pages have is main text where it holds a paragraph of its own."""
    note = "<div class='box'>A correction to story 3: the bridge was opened in May, not in June of that year.</div>"
    rows = [(k, f"http://gazette.example/{k}", _plain_page(k, note if k == 3 else "<div class='tick'>ok</div>" if k == 4 else "")) for k in range(9)]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3].endswith("the bridge was opened in May, not in June of that year.")
    assert got[4].endswith("as paragraphs do.")


def test_pages_of_one_page_are_counted_once():
    folded = wrappers.fold(wrappers.parse("<div><p>same</p><p>same</p><p>same</p><p>same</p></div>")).children[0].children[0]
    assert folded.repeated and folded.pages == 1 and not folded.children[0].template
    three = [wrappers.fold(wrappers.parse(f"<p>same</p><b>{k}</b>")) for k in range(3)]
    merged = wrappers.merge(wrappers.merge(three[0], three[1]), three[2])
    assert [c.children[0].template for c in merged.children] == [True, False]
    assert wrappers.Node.unpacked(merged.packed()).packed() == merged.packed()
