import random

from pyspark.sql import types as T

from chronoweave.llm.html import extract, parse, render


def text(s):
    return render(parse(s))[0]


def test_blocks_lists_and_implied_tags():
    assert text("<title>t</title><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<br>five") == "A & B\n\none two three\n\nfour\nfive"
    assert text("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>") == "- a\n- b\n  3. x\n  4. y\n- c"
    assert text("<dl><dt>T<dd>D<dt>U<dd>E</dl>") == "T\n  D\nU\n  E"
    assert text("a<div>b</div>c") == "a\nb\nc"
    assert text("<p>a</p><pre>  x\n    y\n\nz</pre>b") == "a\n\n  x\n    y\n\nz\n\nb"


def test_tables_are_aligned():
    assert text("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>long cell<td>44</table>") == \
        "Name       Qty\napple      3\nlong cell  44"
    assert text("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>") == "wide  z\na  b  c"
    assert text("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>").split() == ["x", "y", "1", "2"]


def test_visibility():
    assert text("<p>a</p><script>var x='<p>b</p>'</script><style>p{}</style><div hidden>c</div><p style='color:red; DISPLAY : none'>d</p>"
                "<template>e</template><!-- f --><noscript>g</noscript><p>h") == "a\n\nh"
    assert text("<details><summary>s</summary>more</details><details open><summary>t</summary>shown</details>") == "s\nt\nshown"


def test_head_without_end_tag():
    assert text("<html><head><title>T</title><p>Hello") == "Hello"
    assert text("<head><meta charset=x><style>p{}</style>\n <script>1</script>plain <b>text") == "plain text"
    assert text("<head><title>T</title><link rel=x></head><body>a") == "a" and text("<head><title>T</title><body>a") == "a"
    assert text("<head><template><p>no</template><noscript><img alt=no></noscript><div>a</div>") == "a"
    assert text("<head> \n<head>&nbsp;a").strip("\xa0") == "a"


def test_svg_and_math_text():
    assert text("<p>a</p><svg><title>no</title><desc>no</desc><defs><text>no</text></defs><g><path d='x'/><text>b <tspan>c</tspan></text>"
                "<text>d</text></g></svg><p>e") == "a\n\nb c\nd\n\ne"
    assert text("<svg><title/><defs/><text>b</text></svg>c") == "b\nc" and text("<svg><text><![CDATA[x &lt; y]]></text></svg>") == "x &lt; y"
    assert text("<svg><foreignObject><p>f</p></foreignObject><text display=none>no</text></svg>g") == "f\n\ng"
    assert text("<svg><path d=x><p>out") == "out"
    assert text("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>no</annotation></math> holds") == "so x=1 2 holds"


def test_broken_markup():
    assert text("3 < 4 <a title='x>y'>l</a> <b unclosed=\"q>z</b>") == "3 < 4 l z"
    assert text("</p></div>x</table>") == "x"
    assert text("<script>never closed") == "" and text("") == "" and text("<") == "<"
    assert text("<div>" * 50_000 + "deep") == "deep"
    assert text("<a href='" * 20_000).strip() == ""
    rng = random.Random(4)
    parts = ["<p>", "</p>", "<td>", "<tr>", "<table>", "</table>", "<li>", "</ul>", "<ul>", "x", " ", "<br/>", "<pre>", "</pre>", "\n", "<", ">", "&amp;",
             "<script>", "</script>", "<dd>", "<!--", "-->", "<option>", "<th colspan=9999999999>", "<ol start=-3>", "<hr>", "'", '"', "<a b='"]
    for _ in range(3000):
        text("".join(rng.choice(parts) for _ in range(rng.randint(1, 40))))


def test_all_visible_words_survive_in_order():
    rng = random.Random(5)
    for _ in range(200):
        words, s = [], ""
        for i in range(30):
            tag = rng.choice(["p", "div", "b", "li", "td", "h2", "span"])
            s += f"<{tag}>w{i}</{tag}> "
            words.append(f"w{i}")
        got = [w for w in text(s).replace("- ", " ").split() if w.startswith("w")]
        assert got == words


def test_table_of_pages(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])
    rows = [(1, None, "clash"), (2, "", "clash"), (None, "<p>x", "clash"), (1, "<p>x", "clash")]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in extract(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (None, "x", 1), (1, "x", 1)], key=str)
    assert extract(spark.createDataFrame([], schema)).collect() == []


# ---- an independent renderer: recursion over random trees, blocks as lists of lines -------

def random_tree(rng, depth, lists=0):
    """Children of a block: words, inline elements and blocks, as nested tuples (tag, children)."""
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["w", "w", "b", "hide"] + (["div", "section", "p", "h2", "quote", "ul", "ol", "table"] if depth else []))
        word = lambda: f"w{rng.randint(0, 999)}"
        if kind == "w":
            out.append(word())
        elif kind == "b":
            out.append(("b", [word(), ("i", [word()])][:rng.randint(1, 2)]))
        elif kind == "hide":
            out.append((rng.choice(["script", "template", "gone"]), ["hidden"]))
        elif kind in ("p", "h2"):
            out.append((kind, [word() for _ in range(rng.randint(0, 3))]))
        elif kind in ("ul", "ol"):
            out.append((kind, [("li", [word(), *random_tree(rng, depth - 1, lists + 1)]) for _ in range(rng.randint(1, 3))]))
        elif kind == "table":
            out.append((kind, [[word() + "x" * rng.randint(0, 5) for _ in range(3)] for _ in range(rng.randint(1, 3))]))
        else:
            out.append((kind, random_tree(rng, depth - 1, lists)))
    return out


def markup(nodes, rng):
    out = []
    for n in nodes:
        space = rng.choice([" ", "\n", "  \t"])
        if isinstance(n, str):
            out.append(n + space)
            continue
        tag, kids = n
        if tag == "table":
            end = rng.random() < 0.5  # cells and rows with and without end tags
            rows = "".join("<tr>" + "".join(f"<td>{c}" + "</td>" * end for c in r) + "</tr>" * end for r in kids)
            out.append(f"<table>{rows}</table>{space}")
            continue
        inner = markup(kids, rng)
        begin = {"quote": "<blockquote>", "gone": "<div style='display: none'>"}.get(tag, f"<{tag}>")
        done = {"quote": "</blockquote>", "gone": "</div>", "li": rng.choice(["</li>", ""])}.get(tag, f"</{tag}>")
        out.append(f"{begin}{rng.choice(['', ' '])}{inner}{done}{space}")
    return "".join(out)


def plain_words(nodes):
    return [w for n in nodes for w in ([n] if isinstance(n, str) else plain_words(n[1]))]


def expected(nodes, lists=0):
    """Lines of a block, with the empty lines that must stand between them as numbers."""
    out, words = [], []

    def flush():
        if words:
            out.append(" ".join(words))
            words.clear()

    for n in nodes:
        if isinstance(n, str):
            words.append(n)
        elif n[0] == "b":
            words.extend(plain_words([n]))
        elif n[0] in ("script", "template", "gone"):
            pass
        else:
            flush()
            tag, kids = n
            gap = 1 if tag in ("div", "section") or (tag in ("ul", "ol") and lists) else 2
            out.append(gap)
            if tag in ("ul", "ol"):
                for k, (_, item) in enumerate(kids, 1):
                    lines, mark = expected(item, lists + 1), f"{k}. " if tag == "ol" else "- "
                    first = next(i for i, x in enumerate(lines) if isinstance(x, str))
                    out += [1, *[x if isinstance(x, int) else (mark if i == first else " " * len(mark)) + x for i, x in enumerate(lines)], 1]
            elif tag == "table":
                width = [max(len(r[c]) for r in kids) for c in range(3)]
                out += ["  ".join(x.ljust(w) for x, w in zip(r, width)).rstrip() for r in kids]
            elif tag == "quote":
                out += [x if isinstance(x, int) else "  " + x for x in expected(kids, lists)]
            else:
                out += expected(kids, lists)
            out.append(gap)
    flush()
    return out


def assembled(lines):
    out, gap = [], 0
    for x in lines:
        if isinstance(x, int):
            gap = max(gap, x)
        else:
            out += [""] * (gap > 1 and bool(out)) + [x]
            gap = 0
    return "\n".join(out)


def test_random_trees_against_an_independent_renderer():
    rng = random.Random(11)
    for _ in range(1500):
        tree = random_tree(rng, 3)
        html = markup(tree, rng)
        assert text(html) == assembled(expected(tree)), html
