"""Column builders on small values with the results that they must give."""

from pyspark.sql import functions as F

from corpusmill.functions import dates, html as H, predicates, text as X, urls, wikitext
from corpusmill.operators import unify


def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_categories(spark):
    found = {"khaly-izhady": "khaly-izhady", "Новости": None, "24 октября 2026": None, "sport": None, "Sport": "Sport", "{json}": None, "  Наука  и  жизнь ": "Наука и жизнь", "a-b-c": None, "Культура 5 мая": None, "ёж-Ёж": "ёж-Ёж", "x" * 121: None}
    df = rows(spark, "v string", *[(k,) for k in found], (None,))
    assert pairs(df.select("v", predicates.category("v"))) == [*found.items(), (None, None)]
    measured = pairs(df.where("v IN ('khaly-izhady', 'Sport', 'ёж-Ёж')").select(predicates.category("v", measuring=True)))
    assert measured == [(None,), ("Sport",), ("ёж-Ёж",)]


def test_authors(spark):
    good = ["Редакция", "Иван Петров", "Ҷумъа"]
    bad = ["5 минут чтения", "admin", "15 марта 2024", "a@b.c", "x", "", None, "www.site.ru", "Фото: Иван", "Вчера", "Sponsored content", "2024-03-15T10:00", "Dr. May 2", "12 345", "реклама"]
    df = rows(spark, "v string", *[(v,) for v in good + bad])
    assert pairs(df.select(predicates.is_author("v"))) == [(True,)] * len(good) + [(False,)] * len(bad)


def test_author_and_title_match(spark):
    cases = [("Иван Петров", "Петров Иван Сергеевич", True), ("Иван", "Иван Петров", False), ("Иван", "иван", True), ("A. B.", "b a", True), ("A", "B", False), ("", "B", None)]
    df = rows(spark, "a string, b string, m boolean", *cases)
    assert pairs(df.select(predicates.authors_match("a", "b"))) == [(c[2],) for c in cases]


def test_dates(spark):
    cases = [
        ("2024-03-15T10:00:00Z", "2024-03-15T10:00:00+00:00", None, "2024-03-15T10:00:00Z"), ("2024-03-15", "2024-03-15T00:00:00", None, "2024-03-15"), ("15 марта 2024", None, None, "15 March 2024"),
        ("at 9:05 x", None, "9:05", "at 9:05 x"), ("мартал", None, None, "Marchл"), (None, None, None, None), ("1 мая, 7:30", None, "7:30", "1 May, 7:30"),
    ]
    df = rows(spark, "v string, i string, c string, e string", *cases)
    assert pairs(df.select("v", dates.iso("v"), dates.clock("v"), dates.localised("v"))) == cases
    assert [r[0] for r in pairs(df.select(dates.parsed("v")))] == ["2024-03-15T10:00:00+00:00", "2024-03-15T00:00:00", "2024-03-15T00:00:00", "2024-01-01T09:05:00", "Marchл", None, "2024-05-01T07:30:00"]


def test_wikitext(spark):
    cases = [
        ("Kazan", 0, "'''Kazan''' is [[city|a city]] in [[Tatarstan]].{{stub}}", "Kazan is a city in Tatarstan.", "", "", True), ("A", None, 'x<ref name="q">y</ref> &amp; z\n\n\n\nq', "x z\n\nq", "", "", True),
        ("B", 0, "[[Category:Foo]]\n[[Category:Bar]]", "Category:Foo\nCategory:Bar", "Foo]] [[Category:Bar]]", "Bar,Foo", True), ("C", 0, "[[Category:Foo|x]]", "x", "Foo", "Foo", True), ("D", 0, "#REDIRECT [[X]]", "#REDIRECT X", "", "", False), ("E", 1, "talk", "talk", "", "", False),
    ]
    df = rows(spark, "t string, ns int, b string", *[c[:3] for c in cases])
    got = df.select(wikitext.plain("b"), F.array_join(wikitext.categories("b"), ","), F.array_join(wikitext.categories("b", strict=True), ","), wikitext.is_article("t", "b", "ns"))
    assert pairs(got) == [c[3:] for c in cases]


def test_comment_lines_and_file_names(spark):
    cases = [("Ali\n2 days ago\nGood video\nThanks", None, "Ali", "Good video\nThanks"), ("Ali\nHello", None, "Ali", "Ali\nHello"), ("x\ny\nz", "Me", "Me", "x\ny\nz"), ("\nAli\nb\nc", None, None, "c"), ("", "", None, "")]
    df = rows(spark, "c string, a string", *[c[:2] for c in cases]).select(unify.rutube_fields("c", "a").alias("u"))
    assert pairs(df.select("u.author", "u.content")) == [c[2:] for c in cases]
    names = [("Tukay_Shurale", "poems/Tukay_Shurale.txt", "Tukay", "Shurale", "poems"), ("a - b-c", "a - b-c.pdf", "a", "b-c", None), ("one-two", "x/y/one-two.md", "one", "two", "x"), ("plain", "plain.txt", None, "plain", None)]
    df = rows(spark, "s string, r string", *[n[:2] for n in names]).select(unify.file_fields("s").alias("m"), unify.rubric("r"))
    assert [(r[0]["author"], r[0]["title"], r[1]) for r in df.collect()] == [n[2:] for n in names]


def test_addresses(spark):
    paging = [("https://a/page/3", "https://a/page/2", False), ("https://a/x", "https://a/page/2", True), ("https://a/x", "https://a/page/1", False), ("https://a/?page=2", "https://a/?page=3", True), ("https://a/?p=4", "https://a/?p=3", False), ("https://a/page/3", "https://a/x", False), ("https://a/x", "https://a/y", True)]
    assert pairs(rows(spark, "a string, b string", *[p[:2] for p in paging]).select(urls.is_forward("a", "b"))) == [(p[2],) for p in paging]
    links = [("https://a.tj/x/", "../y#z", "https://a.tj/y", None, "x"), ("https://a.tj/x/", "mailto:q", None, None, "x"), ("https://a.tj/2024/03/n/", "https://b.tj/q#r", "https://b.tj/q", "2024-03", "2024"), ("https://a.tj/page/2", "", None, None, None), ("https://a.tj/", "/n/", "https://a.tj/n/", None, None)]
    df = rows(spark, "b string, h string", *[x[:2] for x in links])
    assert pairs(df.select(urls.absolute("b", "h"), urls.year_month("b"), urls.section("b"))) == [x[2:] for x in links]


def test_normal_form_and_ordered_distinct(spark):
    df = rows(spark, "t string", ("Ｈｅｌｌｏ,  World!\n",), ("ﬁ ①",), ("Plain, text.",), (None,))
    assert pairs(df.select(X.normal_form("t"))) == [("hello world",), ("fi 1",), ("plain text",), (None,)]
    df = rows(spark, "t string", ("b,a,b,,c",), ("",), ("x",))
    assert pairs(df.select(F.array_join(X.distinct_kept(F.split("t", ",")), ","))) == [("b,a,c",), ("",), ("x",)]


def test_bylines(spark):
    cases = [
        ('<body><span class="byline">Ali Vali</span><p>x</p></body>', "Ali Vali", "css:.byline"), ("<body><p>Long text.</p><p>Автор: Иван Петров</p></body>", "Автор: Иван Петров", "regex:0"), ("<body><p>Редакция</p></body>", "Редакция", "regex:11"),
        ("<body><p>no name here</p></body>", None, None), (None, None, None), ('<div class="x_author_y">A</div><p>Язган Гали</p>', "Язган Гали", "regex:8"),
    ]
    df = rows(spark, "h string", *[c[:1] for c in cases]).select(H.bylines("h").alias("b"))
    assert pairs(df.select("b.text", "b.source")) == [c[1:] for c in cases]
