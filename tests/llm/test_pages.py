"""Web archives, main text and URL verdicts."""

import hashlib
import math
import random
import re
from collections import Counter
from html import unescape

import pytest

from vigia.llm import htmltext, urlfilter, warc
from vigia.llm.queries import QUERIES, URL_RULES
from vigia.llm.urlfilter import Rule

# --- Archives ------------------------------------------------------------------------------------------------------------

RECORD = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAYLOADS = ["x" * 150, "x" * 150, None, "", f"\n{RECORD}\nWARC/1.1 z" * 30, "a\r\n", RECORD, "\r\n\r\n", "é" * 200, "y" * 3000,
            "\nWARC/1." * 200, "z\n", "x" * 150, f"\n{RECORD}" * 100]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_archives_with_magic_in_payloads_and_splits(spark, small_splits):
    rows = [(i, f"http://h/{i} \nWARC/1.1", p, 1) for i, p in enumerate(PAYLOADS)]
    rows += [(None, None, "q" * 200, 2), (None, None, "q" * 200, 2), (50, "u", "q" * 200, 3)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int").repartition(3)
    records = warc.round_trip(table).collect()
    assert len(records) == len(rows) == len({(r["file"], r["start"]) for r in records})
    found = {r["id"]: r for r in records}
    for id, _, payload, _ in rows:
        if id is None:
            continue
        data = (payload or "").encode()
        record, digest = found[f"<urn:page:{id}>"], hashlib.sha256(data).hexdigest()
        if id in (1, 12):
            assert (record["type"], record["refers"], record["said_bytes"]) == ("revisit", "<urn:page:0>", 150)
            assert record["said_digest"] == f"sha256:{digest}"
        else:
            assert (record["type"], record["length"], record["digest"]) == ("response", len(data), digest)
    assert sum(r["id"] == "<urn:page:none>" and r["type"] == "response" for r in records) == 2
    assert warc.round_trip(table.limit(0)).count() == 0


def test_broken_archives(spark, tmp_path):
    (tmp_path / "good.warc").write_bytes(RECORD.encode() * 2)
    (tmp_path / "cut.warc").write_bytes((RECORD + RECORD[:-9]).encode())
    (tmp_path / "no.warc").write_bytes(b"junk\n" + RECORD.encode())
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "gap.warc").write_bytes((RECORD + "junk\n" + RECORD).encode())
    found = sorted((r["file"].rsplit("/", 1)[1], r["start"], r["digest"] is not None) for r in warc.read_archives(spark, str(tmp_path)).collect())
    assert ("good.warc", 0, True) in found and ("good.warc", len(RECORD), True) in found
    assert ("cut.warc", 0, True) in found and ("cut.warc", len(RECORD), False) in found
    assert not any(f in ("no.warc", "empty.warc") for f, *_ in found)
    assert not any(f == "gap.warc" and start > 0 for f, start, _ in found)


def test_reachable_by_jumps(spark):
    links = [("f", i, i + 1) for i in range(40)] + [("f", 100, 5), ("g", 3, 4), ("h", 0, 9), ("h", 9, 11), ("h", 10, 11)]
    found = warc.reachable(spark.createDataFrame(links, "file string, start bigint, next bigint")).collect()
    assert {tuple(r) for r in found} == {*(("f", i) for i in range(41)), ("h", 0), ("h", 9), ("h", 11)}


def test_every_page_comes_back(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    rows = {r["page_id"]: r for r in QUERIES["op1_warc"](spark, small).collect()}
    first = {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault(p["html"], p["page_id"])
    assert len(rows) == len(pages)
    for p in pages:
        data, row = p["html"].encode(), rows[p["page_id"]]
        copy = len(data) >= 100 and first[p["html"]] != p["page_id"]
        assert tuple(row) == (p["page_id"], len(data), hashlib.sha256(data).hexdigest(), "revisit" if copy else "response", first[p["html"]] if copy else None)


# --- Main text -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("html,text", [
    ("<p>a<p>b", "a\nb"), ("<ul><li>x<li>y</ul>", "x\ny"), ("a<br>b &amp; c &nbsp;\n d", "a b & c d"), ("x<span class=ad>AD</span>y", "xy"),
    ("<div class='comment-list'><p>no</p></div><div>yes <b>bold</b><i>er</i></div>", "yes bolder"), ("", ""), ("   ", ""),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("5 < 6 > 2 <", "5 < 6 > 2 <"), ("<p>un<b", "un"), ("<script>if (a<b) {}</script>t", "t"),
    ("<!-- x --><p>t<!-- > --> u</p><form>f</form><aside>q</aside>", "t u"), ("<nav><p>n</nav>z", "z"), ("<p>&lt;b&gt; &#233;&copy;", "<b> é©"),
    ("<article><h1>T</h1><p><b>s<br><p>t</article><footer>f</footer>", "T\ns\nt"), ("<b>" * 2000 + "deep", "deep"), ("<style>p{}</style><noscript>n</noscript>k", "k"),
    ("<div hidden>h</div><div style='display:none'>i</div>j", "j"), ("<dl><dt>a<dd>b<dt>c</dl>", "a\nb\nc"), ("</p></div>q", "q"),
    ("<p title='a>b'>x</p>", "x"), ("<p don't>x</p><p>it's</p>", "x\nit's"), ("<p title=\"x>y</p>z", "y\nz"), ("<a " + "b='c' " * 5000, ""),
    ("<div id=cookie-notice>c</div><div class=sidebar>s</div><div class=siteHeader>h</div>m", "m"),
])
def test_blocks(html, text):
    assert htmltext.main_text(htmltext.blocks(html), set()) == text


def test_template_branches_are_cut_by_entropy(spark):
    def page(k):
        return (f"<html><body><div class=top>Welcome to this site</div><div class=links><a href=1>one</a> <a href=2>two {k}</a></div>"
                f"<div class=c><p>Story {k} is told here.</p><p>All stories end alike.</p></div><div class=end>The same end</div></body></html>")

    rows = [(k, f"http://A.example/{k}", page(k), "x") for k in range(20)] + [(100, "http://b.example/1", page(0), "x"), (101, None, None, "x"), (101, None, None, "x")]
    rows += [(200 + k, f"http://c.example/{k}", "<article><p>Every page has this.</p></article>", "x") for k in range(20)]
    found = {}
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars string")
    for r in htmltext.extract(table).collect():
        found.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    assert all(found[k] == [(f"Story {k} is told here.\nAll stories end alike.", len(f"Story {k} is told here.\nAll stories end alike."))] for k in range(20))
    # One page alone tells nothing about its template; an article stays whatever it repeats.
    assert found[100][0][0].startswith("Welcome") and found[101] == [("", 0), ("", 0)]
    assert all(found[200 + k] == [("Every page has this.", 20)] for k in range(20))
    assert htmltext.extract(table.limit(0)).count() == 0


def test_copies_of_a_page_count_once(spark):
    def page(text):
        return f"<html><body><div class=top>Welcome to this site</div><div id=content><p>{text}</p></div></body></html>"

    rows = [(k, f"http://a.example/{k}", page("One text under many urls.")) for k in range(8)]
    rows += [(100 + k, f"http://b.example/{k}", page("Copied 75 times." if k < 75 else f"Told only by page {k}.")) for k in range(100)]
    # Of a page of nothing but what all others have nothing is left.
    rows += [(300, "http://b.example/top", "<html><body><div class=top>Welcome to this site</div></body></html>")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = {r["page_id"]: r["text"] for r in htmltext.extract(table).collect()}
    assert all(found[k] == "Welcome to this site\nOne text under many urls." for k in range(8))
    assert all(found[100 + k] == ("Copied 75 times." if k < 75 else f"Told only by page {k}.") for k in range(100))
    assert found[300] == ""


@pytest.mark.parametrize("html,want", [
    ('<p title="a hidden gem">text</p>', "text"),
    ('<p hidden>no</p><p HIDDEN="">no</p><p style="color:red;display : none">no</p><p aria-hidden=true>no</p><p data-hidden="x">yes</p>', "yes"),
    ('<div data-id="comment-5"><p>kept?</p></div>', "kept?"),
    ('<div id="comment-5"><p>no</p></div><p>x</p>', "x"),
    ('<article><p data-role="notice">kept</p></article>', "kept"),
    ('<article><p class="share-price">Share price rose</p></article>', "Share price rose"),
    ('<article><p id="skip">kept</p><div class="skip-intro">kept too</div></article>', "kept\nkept too"),
    ('<article><p>a</p><div class="box comments"><p>no</p></div><ul class=share><li>no</li></ul><nav>no</nav><p>b</p></article>', "a\nb"),
    ("<article><header><h1>Title</h1></header><p class='it\"s'>b</p></article>", "Title\nb"),
    ("<div>" * 600 + "<nav>menu</nav><p>x</p>", "x"),
    ("<div>" * 600 + "<article><div class=ads>no</div><p>x</p></article>", "x"),
])
def test_attributes_are_names_and_values(html, want):
    assert htmltext.main_text(htmltext.blocks(html), set()) == want


def test_entropies_equal_plain_counts(spark):
    """On pages whose classes say nothing."""
    rng = random.Random(8)
    pages = []
    for host, count in (("a", 3), ("b", 7), ("c", 12), ("d", 40)):
        for k in range(count):
            top, mid = rng.choice(["one", "two", "one", "one"]), f"text {rng.randrange(max(1, k // 2 + 1))}"
            menu = "".join(f"<a href={i}>link {i}</a> " for i in range(3)) + (f"page {k}" if rng.random() < 0.3 else "")
            pages.append((host, f"<body><div class=x1>{top}</div><div class=x2><p>{mid}</p><p>{k} told</p></div><ul class=x3><li>{menu}</li></ul></body>"))
    pages += pages[:5]  # copies
    held = {}
    for host, html in set(pages):
        for node, content, linked in htmltext.contents(htmltext.blocks(html)):
            held.setdefault((host, node), []).append((content, linked))
    want = set()
    for key, found in held.items():
        m, counts = len(found), Counter(c for c, _ in found)
        entropy = -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m) if m > 1 else 1.0
        if (m * entropy + 3) / (m + 3) < 0.3 or sum(x for _, x in found) / (m + 3) > 0.6:
            want.add(key)
    got = {tuple(r) for r in htmltext.style_trees(spark.createDataFrame(pages, "host string, html string").repartition(3)).collect()}
    assert got == want and {h for h, _ in got} >= {"c", "d"} and "a" not in {h for h, _ in got}


def test_articles_of_pages(spark, small):
    rows = {r["page_id"]: r for r in QUERIES["op6_main_text"](spark, small).collect()}
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inner = re.search(r"(?s)<article>(.*)</article>", p["html"]).group(1)
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(b for b in blocks if b)
        assert (rows[p["page_id"]]["text"], rows[p["page_id"]]["n_chars"]) == (want, len(want))


# --- URLs ----------------------------------------------------------------------------------------------------------------


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def hit_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


ODD_URLS = [None, "", "no scheme/net/", "http://", "http://X.Example.NET/en/a?b=/c#d", "http://net", "http://net/", "https://a.net?x://y", "ftp://ÀB.org/fr/x",
            "http://notexample.net/en/", "a://b://c.org/fr/", "http://u@h.net:80/", "http://example.com/de", "http://example.com/de/#?/", "x" * 5000, "http://h.org/fr/%s" % ("1" * 5000)]


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(ODD_URLS * 2)], "page_id bigint, url string, rule string")
    found = urlfilter.judge(rows, URL_RULES).collect()
    assert len(found) == 2 * len(ODD_URLS)
    for r in found:
        host, path = split_url((ODD_URLS * 2)[r["page_id"]])
        name, verdict = hit_of(host, path, URL_RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, name)
        assert r["verdict"] == verdict or name is None and r["verdict"] in ("allow", "block")
    assert {r["verdict"] for r in urlfilter.judge(rows, [Rule("net", "/", "block")]).where("rule IS NULL").collect()} == {"block"}
    assert {r["verdict"] for r in urlfilter.judge(rows, []).collect()} == {"allow"}
    assert urlfilter.judge(rows.limit(0), URL_RULES).count() == 0


def test_trees_learn_the_labels(spark):
    rows = [(i, f"http://{'spam-%d.biz' % i if i % 2 else 'site.edu'}/{'9' * (i % 7) if i % 2 else 'page'}/{i}") for i in range(400)]
    table = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = [Rule(f"spam-{i}.biz", "/", "block") for i in range(1, 400, 4)] + [Rule("site.edu", "/page/", "allow")]
    found = urlfilter.judge(table, rules).where("rule IS NULL").collect()
    assert len(found) > 50 and {r["verdict"] for r in found} == {"block"}


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op9_urls"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
