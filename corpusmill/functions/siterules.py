"""Extraction by a site's rules: named strategies for authors and categories, dates, content, links to rubrics.

The tree finds what each strategy would give; which of the findings may stand (an acceptable author or category, a date
that can be read) is decided afterwards by Column expressions, in the order of the strategies.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, fields
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import html as H
from . import predicates, urls
from .text import col

# Default orders and selectors, places of author names, menus, addresses inside scripts, URL patterns.
AUTHOR_STRATEGIES = ("meta_tag", "class_selector", "style_based", "json_ld_graph", "json_ld_simple", "regex_in_content", "priority_list", "default_fallback")
TITLE_SELECTORS = ('meta[property="og:title"]', 'meta[name="twitter:title"]', "h1", "title")
DATE_SELECTORS = ('meta[property="article:published_time"]', 'meta[name="pubdate"]', 'meta[name="published_date"]', 'meta[itemprop="datePublished"]', 'meta[name="published_at"]', "time[datetime]")
AUTHOR_SELECTORS = ('meta[property="article:author"]', 'meta[name="author"]', 'meta[name="Author"]')
CATEGORY_SELECTORS = ('meta[property="article:section"]', 'meta[name="section"]', ".breadcrumb a", "nav.breadcrumb a")
AUTHOR_CLASSES = (
    ".author", ".article-author", ".byline", ".by", ".c-author", ".c-author__content", ".media-block__title--author", ".post-author", ".news-author",
    "[class*='_authors_'] [class*='_item_']", "[class*='_authors_']", "[class*='author']",
)
NAME = r"([A-Za-zА-Яа-яЁёӨөҮүҚқҒғҲҳӢӣЪъІіЇї'’\-\.\s]{2,120})"
AUTHOR_PATTERNS = (r"(?:Author|By|From\s+the\s+author|Prepared(?:by)?|Text\s+author)\s*[:\-]?\s*" + NAME, r"(?:written\s+by|reported\s+by)\s*[:\-]?\s*" + NAME)
JSON_AUTHORS = (r'"author"\s*:\s*\[\s*\{[^}]*?"name"\s*:\s*"([^"]+)"', r'"@type"\s*:\s*"Person"\s*,\s*"name"\s*:\s*"([^"]+)"')
JSON_DATE = r'"datePublished"\s*:\s*"([^"]+)"'
AUTHOR_PREFIX = r"(?i)^(Author|By|From the author)\s*[:\-]?\s*"
CATEGORY_PATTERNS = ("/category/([^/]+)", "/rubric/([^/]+)", r"/articles/([^/]+)/\d{4}", "/bahsho/([^/]+)/", "/prezidenti-t/([^/]+)/", "/uato/([^/]+)/", "/alasao/([^/]+)/", "/news/([^/]+)/")
MENUS = (
    "nav", "header", ".menu", ".nav", ".navigation", "ul.menu", "ul.nav", "div.nav", "div.menu", "ul.main-nav__list", "ul.navbar-nav", "ul.nav__list",
    "div.main-menu", "ul.the-menu", "ul#main-menu", "ul#menu-primary-menu", "div.np-widget-rubric",
)
STATE_PATTERNS = (r"""https?://[^"'\s<>]+""", r"""/(?:news|rubric|category|tag|article|post|a)/[^"'\s<>]*""")
STATE_KEYS = ("path", "href", "url")
NEXT_TEXTS = ("Next", "→", ">", "Следующая", "следующая")


@dataclass(frozen=True)
class Rules:
    """What a site's configuration says about its pages."""

    author_strategy: tuple[str, ...] = AUTHOR_STRATEGIES
    author_selectors: tuple[str, ...] = AUTHOR_SELECTORS
    author_patterns: tuple[str, ...] = AUTHOR_PATTERNS
    default_author: str | None = None
    title_selectors: tuple[str, ...] = TITLE_SELECTORS
    date_selectors: tuple[str, ...] = DATE_SELECTORS
    category_strategy: tuple[str, ...] = ()
    category_selectors: tuple[str, ...] = CATEGORY_SELECTORS
    category_url_patterns: tuple[str, ...] = CATEGORY_PATTERNS
    content_selectors: tuple[str, ...] = ()
    remove_selectors: tuple[str, ...] = ()
    noise_words: tuple[str, ...] = ()
    rubric_strategy: tuple[str, ...] = ("menu_scraping",)
    rubric_selectors: tuple[str, ...] = ()
    pagination_selectors: tuple[str, ...] = ()
    article_url_filters: tuple[str, ...] = ()
    article_url_excludes: tuple[str, ...] = ()
    nuxt_url_regexes: tuple[str, ...] = STATE_PATTERNS
    nuxt_json_keys: tuple[str, ...] = STATE_KEYS

    @classmethod
    def of(cls, site: Mapping) -> Rules:
        """The rules in a resolved configuration; what it leaves empty has its default."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v if k == "default_author" else tuple(v) for k, v in site.items() if k in known and v})


def looks_like_json(s: str) -> bool:
    return (s[:1] == "{" and s[-1:] == "}") or (s[:1] == "[" and s[-1:] == "]") or (len(s) > 300 and ("@context" in s or "@type" in s))


def shown(node: H.Node | None) -> str | None:
    """A meta element's content, else the text; scripts have none."""
    if node is None or node.tag == "script":
        return None
    return (H.squeezed(node.attrs.get("content")) if node.tag == "meta" else None) or H.squeezed(node.text(skip=frozenset({"script", "style"}))) or None


def first_shown(root: H.Node, selectors: Iterable[str], fits: Callable[[str], bool] = bool) -> str | None:
    """What the first node of a selector shows, of the first selector whose value fits."""
    return next((v for s in selectors if (v := shown(H.first(root, s))) and fits(v)), None)


def short(s: str) -> bool:
    return len(s) < 300 and not looks_like_json(s)


class SitePage(H.Page):
    """A page under a site's rules."""

    def __init__(self, html: str | None, url: str | None, rules: Rules):
        super().__init__(html, url)
        self.html, self.rules = html or "", rules

    @cached_property
    def blocks_of_data(self) -> list[str]:
        return ["".join(n.strings()) for n in self.root.walk() if n.tag == "script" and "ld+json" in n.attrs.get("type", "")]

    def in_data(self, patterns: Iterable[str]) -> str | None:
        """The first match of a pattern in the JSON-LD blocks as text, for those that can't be parsed or are shaped otherwise."""
        return next((H.squeezed(m[1]) for b in self.blocks_of_data for p in patterns if (m := re.search(p, b, re.S))), None)

    @cached_property
    def data_author(self) -> str | None:
        return H.name_in(H.deep(self.data, "author")) or self.in_data(JSON_AUTHORS)

    def author(self, strategy: str) -> str | None:
        r = self.rules
        if strategy == "meta_tag":
            return first_shown(self.root, r.author_selectors, short)
        if strategy == "class_selector":
            return first_shown(self.root, AUTHOR_CLASSES, short)
        if strategy == "style_based":
            marked = (n for n in self.root.walk() if any(w in n.attrs.get("style", "").lower() for w in ("author", "byline")))
            return next((t for n in marked if (t := H.squeezed(n.text())) and short(t)), None)
        if strategy in ("json_ld_graph", "json_ld_simple"):
            return self.data_author
        if strategy == "regex_in_content":
            text = H.squeezed(self.root.text(skip=frozenset({"script", "style"})))
            return next((v for p in r.author_patterns if (m := re.search(p, text, re.I)) and (v := H.squeezed(m[1]))), None)
        return r.default_author if strategy == "default_fallback" else None  # priority_list stands for no strategy of its own

    def dates(self) -> list[str]:
        """Candidates: the JSON-LD date, by pattern if need be, then what each selector's first node holds."""
        found = [H.deep(self.data, "datePublished", "dateModified") or self.in_data([JSON_DATE])]
        for s in self.rules.date_selectors:
            node = H.first(self.root, s) if "ld+json" not in s else None
            if node is not None and node.tag != "script":
                found.append(node.attrs.get("content") or node.attrs.get("datetime") or node.text())
        return [t for x in found if isinstance(x, str) and (t := H.squeezed(x))]

    def category(self) -> list[str]:
        """Candidates that the tree gives; those of the address come from expressions."""
        return [v for s in self.rules.category_selectors if (v := shown(H.first(self.root, s)))]

    @cached_property
    def cleaned(self) -> H.Node:
        for s in self.rules.remove_selectors:
            for n in H.select(self.root, s):
                if n.parent is not None:
                    n.parent.parts = [p for p in n.parent.parts if p is not n]
        return self.root

    def content(self) -> str:
        """Blocks of the container, or of the page, without those that hold a noise word or are shorter than three characters."""
        node = H.container(self.cleaned, self.rules.content_selectors) or self.cleaned
        noise = [w.lower() for w in self.rules.noise_words]
        return H.block_text([(tag, t) for tag, t in H.blocks(node) if len(t) >= 3 and not any(w in t.lower() for w in noise)])

    def nexts(self) -> list[str]:
        """Where the next page may be: links of the pagination selectors, then those whose text says so."""
        nodes = [n for s in self.rules.pagination_selectors for n in H.select(self.root, s)]
        nodes += [n for n in self.root.walk() if n.tag == "a" and any(w in H.squeezed(n.text()).lower() for w in map(str.lower, NEXT_TEXTS))]
        return [to for n in nodes if (to := H.link_of(self.url, n.attrs.get("href")))]

    # --- links to rubrics

    def menu(self) -> list[str]:
        """Links of the site's menu selectors; where those give fewer than three, also of the usual menus."""
        found = [to for s in self.rules.rubric_selectors for n in H.select(self.root, s) if (to := H.link_of(self.url, n.attrs.get("href")))]
        if len(set(found)) < 3:
            found += [to for s in MENUS for box in H.select(self.root, s) for n in box.walk() if n.tag == "a" and (to := H.link_of(self.url, n.attrs.get("href")))]
        return found

    def matching(self) -> list[str]:
        """Links whose address is one of an article's and no noise."""
        parts = tuple(p.lower() for p in self.rules.article_url_filters) or urls.ARTICLE_PARTS
        out = [u for u, _ in H.links(self.root, self.url) if any(p in u.lower() for p in parts)]
        return [u for u in out if not any(x.lower() in u.lower() for x in (*self.rules.article_url_excludes, *predicates.NOISE_PARTS))]

    def state(self) -> list[str]:
        """Addresses in the text of the page's scripts."""
        found = [m for p in self.rules.nuxt_url_regexes for m in re.findall(p, self.html, re.I | re.M)]
        found += [m for k in self.rules.nuxt_json_keys for m in re.findall(rf'"{re.escape(k)}"\s*:\s*"([^"]+)"', self.html, re.I)]
        return [to for m in found if (to := H.link_of(self.url, m))]

    def escalating(self) -> list[str]:
        """The menu alone; while that is fewer than three, also matching links, then addresses in scripts."""
        out = list(dict.fromkeys(to for s in self.rules.rubric_selectors for n in H.select(self.root, s) if (to := H.link_of(self.url, n.attrs.get("href")))))
        for more in (self.matching, self.state):
            if len(out) < 3:
                out += more()
        return out

    def rubrics(self) -> list[str]:
        """Links by the site's strategies in turn, each once; context_passed in the first place means the page itself."""
        if self.rules.rubric_strategy[:1] == ("context_passed",):
            return [self.url]
        known = {"menu_scraping": self.menu, "pattern_fallback": self.matching, "nuxt_state_parsing": self.state, "auto_detect_multi": self.escalating}
        return list(dict.fromkeys(u for s in self.rules.rubric_strategy if s in known for u in known[s]() if u.startswith(("http://", "https://"))))


GIVEN = {
    "title": ("string", lambda p: first_shown(p.root, p.rules.title_selectors) or H.value_of(H.first(p.root, "title"))),
    "dates": ("array<string>", SitePage.dates),
    "authors": ("array<struct<strategy:string,value:string>>", lambda p: [{"strategy": s, "value": v} for s in p.rules.author_strategy if (v := p.author(s))]),
    "categories": ("array<string>", SitePage.category),
    "rubrics": ("array<string>", SitePage.rubrics),
    "nexts": ("array<string>", SitePage.nexts),
    "links": ("array<struct<url:string,text:string>>", H.FIND["links"]),
    "items": ("array<struct<url:string,title:string,content:string,date:string>>", H.FIND["items"]),
    "page_type": ("string", H.FIND["page_type"]),
    "image": ("string", H.FIND["image"]),
    "content": ("string", SitePage.content),  # the last: it takes elements out of the tree
}


def given(html: Column | str, url: Column | str, site: Column, rules: Mapping[str, Rules], names: tuple[str, ...] = tuple(GIVEN)) -> Column:
    """A struct of what pages give under the rules of their sites, one parse each; a site without rules has the defaults."""
    order, plain = [n for n in GIVEN if n in names], Rules()

    def find(h: str | None, u: str | None, s: str | None) -> dict:
        page = SitePage(h, u, rules.get(s, plain))
        found = {n: GIVEN[n][1](page) for n in order}
        H.let_go(page.root)
        return found

    ddl = "struct<" + ", ".join(f"{n}:{GIVEN[n][0]}" for n in order) + ">"
    return H.by_page(find, ddl).asNondeterministic()(html, url, site)  # else a filter would parse again


def accepted_author(authors: Column | str) -> Column:
    """struct(strategy, value): the first author that can be one, without a leading `By`."""
    clean = F.transform(col(authors), lambda a: F.struct(a["strategy"].alias("strategy"), F.trim(F.regexp_replace(a["value"], AUTHOR_PREFIX, "")).alias("value")))
    return F.get(F.filter(clean, lambda a: predicates.is_author(a["value"])), F.lit(0))


def url_category(url: Column | str, patterns: Iterable[str] = CATEGORY_PATTERNS) -> Column:
    """The first acceptable category that a pattern finds in an address."""
    return F.coalesce(*[predicates.category(F.nullif(F.regexp_extract(col(url), p, 1), F.lit(""))) for p in patterns])


def accepted_category(url: Column | str, categories: Column | str, by_url: bool = False, patterns: Iterable[str] = CATEGORY_PATTERNS) -> Column:
    """By address where the site says so, then by selectors, then the slug of a rubric list."""
    found = F.get(F.filter(F.transform(col(categories), lambda c: predicates.category(c)), lambda c: c.isNotNull()), F.lit(0))
    slug = predicates.category(F.nullif(F.regexp_extract(F.lower(urls.path(url)), "/news/rubric/list/([^/?]*)", 1), F.lit("")))
    return F.coalesce(*([url_category(url, patterns)] if by_url else []), found, slug)


def probes(html: Column | str, url: Column | str, site: Column, rules: Mapping[str, Rules], against: Mapping[str, str] | None = None) -> Column:
    """array<struct<field, strategy, value, ms>>: what each strategy finds by itself, and how long it takes; with against
    also ref: of each field the named fact of the page, from the same parse."""
    plain = Rules()

    def one(h: str | None, u: str | None, s: str | None) -> list[dict]:
        page = SitePage(h, u, rules.get(s, plain))
        known = {f: H.FIND[n](page) for f, n in (against or {}).items()}  # before content() takes elements out
        page.data_author, page.blocks_of_data  # noqa: B018 - what several strategies share isn't the time of the first
        tries = [("title", "selectors", lambda: first_shown(page.root, page.rules.title_selectors)), ("date", "json_ld", lambda: H.deep(page.data, "datePublished", "dateModified") or page.in_data([JSON_DATE]))]
        tries += [("date", "selectors", lambda: next(iter(v for s in page.rules.date_selectors if (v := H.value_of(H.first(page.root, s), "content", "datetime"))), None))]
        tries += [("author", s, lambda s=s: page.author(s)) for s in page.rules.author_strategy]
        tries += [("category", "selectors", lambda: next(iter(page.category()), None)), ("content", "container", lambda: page.content() or None)]
        out = []
        for field, strategy, find in tries:
            start = time.perf_counter()
            value = find()
            out.append({"field": field, "strategy": strategy, "value": value if isinstance(value, str) else None, "ms": 1000 * (time.perf_counter() - start)} | ({"ref": known.get(field)} if known else {}))
        H.let_go(page.root)
        return out

    return H.by_page(one, f"array<struct<field:string,strategy:string,value:string,ms:double{',ref:string' if against else ''}>>").asNondeterministic()(html, url, site)
