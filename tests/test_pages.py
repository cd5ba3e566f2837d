"""Pages against a small tree builder."""

import random
from html.parser import HTMLParser

import pytest

from peerglass.operators import pages

VOID = set(pages.EMPTY_ELEMENTS) - {"script", "style"}


class Tree(HTMLParser):
    """Elements with their texts; a closing tag closes the last open element of its name and all within it."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.open, self.all, self.fresh = [], [], True
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.fresh = True
        element = (tag, dict(attrs), [])
        self.all.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.fresh = True
        self.all.append((tag, dict(attrs), []))

    def handle_endtag(self, tag):
        self.fresh = True
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                del self.open[place:]
                break

    def handle_comment(self, data):
        self.fresh = True

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, _, texts in self.open:
            if self.fresh or not texts:
                texts.append(data)
            else:
                texts[-1] += data
        self.fresh = False

    def texts(self, names):
        return [" ".join(t.strip() for t in texts if t.strip()) for name, _, texts in self.all if name in names]


def plain_main_text(html, low=200, high=700):
    found = [t for t in Tree(html).texts({"div", "p", "td"}) if len(t) >= low]
    return max(found, key=len)[:high] if found else ""


def values(spark, fn, items):
    df = spark.createDataFrame(list(enumerate(items)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn("v").alias("r")).collect()]


def test_main_text_cases(spark):
    word, long = "a " * 120, "b " * 400
    cases = [
        f"<div>{word}</div><p>{long}</p><td>x</td>", "<p>tiny</p>", None, "", "no tags at all " * 40,
        f"<div>start <p>{word}</p> middle <div>inner</div> {word} the end</div>",
        f"<P CLASS='x'>{word}<b>{word}<p>{word}</p> tail</article></b> after",
        f"<section><div>{word}</section>{word}</div>",  # the section closes the div
        f"<div>{word}</span></p> stays </div>{long}", f"<div>{long}", f"<div/>{long}", f"<br><td>{long}<hr/>x<img src='a>b'>y</td>",
        f"<div><script>var a = '</div>';</script>{word}<style>p{{}}</style><!-- </div> -->tail</div>",
        f"<div>x &lt; y &amp;&nbsp;{word} 1 < 2</div>", f"<div title=\"a > b\">{word}</div>", "<div>" + "é" * 199 + "</div><p>" + "😀" * 200 + "</p>",
    ]
    assert values(spark, pages.main_text, cases) == [plain_main_text(c or "") for c in cases]


@pytest.mark.parametrize("seed", range(4))
def test_main_text_of_random_markup(spark, seed):
    rng = random.Random(seed)
    cases = []
    for _ in range(60):
        parts = []
        for _ in range(rng.choice([5, 40, 120])):
            name = rng.choice(["div", "p", "td", "b", "span", "ul", "li", "DIV"])
            parts.append(rng.choice([f"<{name}>", f"<{name} id='q'>", f"</{name}>", "<br>", "<!-- <div> -->", f"<{name}/>",
                                     "word " * rng.randint(0, 40), "\n", "x", "<script>'<p>'</script>"]))
        cases.append("".join(parts))
    assert values(spark, pages.main_text, cases) == [plain_main_text(c) for c in cases]


def test_deep_and_long_pages_take_time_in_proportion(spark):
    """20,000 and 40,000 pieces in one page, read in seconds."""
    cases = ["<div>" + "<span>word </span>" * n + "</div>" for n in (20_000, 40_000)] + ["<div>" * 300 + "x" * 300 + "</div>" * 300]
    assert [len(v) for v in values(spark, pages.main_text, cases)] == [700, 700, 300]


def test_element_ends_at_its_own_closing_tag(spark):
    html = "<div class='a b'>1<div>2<DIV >3</div></div>4</div>5</div><div class='b'>6</div>"
    assert values(spark, lambda c: pages.element(c, "div", pages.with_class("b")), [html, "<div class='ab'>x</div>", "<div class=b>open", None]) == [
        "1<div>2<DIV >3</div></div>4", None, "open", None]


def test_product_table(spark):
    cases = [
        '<table id="cTB203"><tbody><tr><th><span>A&nbsp;</span></th><td> 60.5 </td></tr><tr><th></th><td>1</td></tr><tr><th>B</th>'
        "<td>39.5</td></tr></tbody></table>",
        "<table><tbody><tr><th>other</th><td>1</td></tr></tbody></table><table id='cTB203'><thead><tr><th>h</th><td>2</td></tr></thead>"
        "<tbody><tr><th>x<span class='cut'>C</span></th><td>0</td><td class='c2 x num'>7</td></tr><tr><th>no cell</th></tr></tbody></table>"
        "<table><tbody><tr><th>later</th><td>1</td></tr></tbody></table>",
        "<table id='cTB203'><tbody><tr><th>D</th><td><i>in</i></td><td>x</td></tr><tr><th>E<td>5</tbody></table>",
        "<table><tbody><tr><th>F</th><td>1</td></tr></tbody></table>", "", None,
    ]
    assert values(spark, pages.product_list, cases) == ["A (60.5%), B (39.5%)", "C (7%)", "D (in%), E (5%)", "", "", ""]


def test_listing_metrics(spark):
    pad = "<i>x</i>" * 200
    cases = [
        ("short", None), (None, None), (pad, "<p>none</p>" + pad),
        (f'<div class="wrap_company"><div>a</div>거래정지</div><em id="_per">1,012.5배</em><em id="_pbr">-</em>{pad}', None),
        (f'<div class="first"><em id="_market_sum"> 1조\n 2,000 </em></div><table class="per_table"><tr><th>PER</th><td>N/A</td></tr></table>{pad}',
         '<div class="fund fl_le"><table class="gHead03"><tbody><tr><th>EV/EBITDA</th><td>-3.5</td></tr></tbody></table></div>'),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string")
    got = [tuple(r.m) for r in df.orderBy("i").select(pages.listing_metrics("a", "b").alias("m")).collect()]
    assert got == [(False, 0.0, None, None, None)] * 3 + [(True, 0.0, 1012.5, None, None), (False, 12000.0, None, None, -3.5)]
