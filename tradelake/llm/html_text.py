"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from few templates.  The tokens of a page are its structural tags, told apart by
the path of structural elements around them, and its stretches of text, told apart by path and content.
A token's occurrence vector lists how often each of the host's pages has it.  Tokens with equal vectors
form a class; classes with enough pages and tokens, in one order wherever they occur, are parts of the
template.  A class whose tokens all lie between two tokens of another is nested there; what stays between
neighbouring template tokens are slots.

A vector is never gathered: a token's sums over pages of two hashes of (page, count), its number of pages
and of occurrences identify it, so classes come from one aggregation over (host, token), however many pages
a host has.

A page's text is what its slots hold, without those in regions of navigation, notices, adverts, forms or
comments, which the names of elements and roles around them tell.  A class or id tells it only if all its words
name such a region or its place and shape (``sidebar-left``, ``comment list``); one that has other words too
(``widget-text``, ``related-topic-summary``) is a hint, which the region must confirm: half of its characters are in
links, or are texts of the template.  Text tokens of the template go,
in an article or main element too.  There pages also repeat prose, so a text is the template's only if it is
in a class with tags, or stands at one distance from the beginning or the end of the content on all pages that
have it; and if more of a page's content repeats than varies, the pages are copies and all of it stays.  A
page with an article or main element has its slots inside it; on others all slots that are left are the text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .url_rules import url_host

#: A template token is on this share of a host's pages, and on this many, at least.
SHARE, LEAST_PAGES = 0.5, 2
#: Pages that repeat a text in an article or main element before it can be the template's.
LEAST_INSIDE = 3
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|select|button|canvas|audio|video"
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|itemprop)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: Elements by their part in a page.
STRUCTURAL = frozenset("html head body div section article main nav header footer aside form ul ol dl table tbody thead tfoot tr td th figure fieldset dialog menu details blockquote center".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset("article main".split())
ASIDE_TAGS = frozenset("head nav header footer aside form dialog menu fieldset".split())
WRAPPER_TAGS = frozenset("form fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay sidebar "
    "widget menu nav navbar navigation breadcrumb breadcrumbs comment comments disqus respond reply replies related recommended share sharing social newsletter subscribe subscription "
    "login signup header footer masthead topbar pagination pager toolbar skip alert disclaimer".split()
)
#: Words that say where such a region is or what it looks like, and nothing of what it holds.
PLACE_WORDS = frozenset("area bar block bottom box button buttons center col column container desktop fixed footer global group header holder home horizontal inner items item left links link list main mobile outer page panel primary right row secondary section site small sticky top vertical wrap wrapper".split())
SPLIT = re.compile(r"[^a-z]+")
#: A class or id with one of these says what else a page has; it isn't a component's own name.
RELATIONS = frozenset("no not with without has have is".split())


def region(name: str, attributes: str) -> tuple[str, int]:
    """(key, kind) of a structural element: its name with its class and role, and whether it is content (1), an aside (2), one unless it holds the content (3) or one if it proves so (4)."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    key = name + "".join(f".{re.sub(r'[0-9]+', '0', found[x])}" for x in ("class", "role") if x in found)
    names = [set(SPLIT.split(w)) for x in ("class", "id") if x in found for w in found[x].split()]
    role = found.get("role", "")
    if name in CONTENT or role == "main" or found.get("itemprop") == "articlebody":
        return key, 1
    if name in ("html", "body"):
        return key, 0
    if name in ASIDE_TAGS - WRAPPER_TAGS or role in ASIDE_ROLES or "hidden" in found or found.get("aria-hidden") == "true":
        return key, 2
    hints = [w - {""} for w in names if w & ASIDE_WORDS and not w & RELATIONS]
    if name in WRAPPER_TAGS or any(w <= ASIDE_WORDS | PLACE_WORDS for w in hints):
        return key, 3
    return key, 4 if hints else 0


def parse(page: str | None, repeated: frozenset[int] = frozenset()) -> list[tuple[int, str, int, int, str]]:
    """Tokens of a page in order: (what: 0 tag, 1 text; path; content depth; aside; text or tag).

    ``repeated`` are keys of texts that other pages of the host have: with links they prove asides that are only hinted at.

    ``content`` is 1 inside an article or main element, ``aside`` 1 inside a region that isn't main text.
    Unclosed elements end with their parent; stray end tags are dropped.  While a page is read, ``aside`` of
    what only names or forms make an aside lists these elements; those around the content are none then.
    """
    out: list[tuple] = []
    stack: list[tuple] = []
    path, content, aside = "", 0, 0
    held: list[list] = []  # content elements in such asides: their asides, first and last token
    hinted: dict[int, list[int]] = {}  # asides that must prove so: characters of text, of these in links or repeated
    parts: list[str] = []
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((1, path, content, aside, text))
                if hinted and isinstance(aside, tuple):
                    proof = len(text) if repeated and token_key(out[-1]) in repeated else min(linked, len(text))
                    for x in aside:
                        if x in hinted:
                            hinted[x][0] += len(text)
                            hinted[x][1] += proof
        linked = 0

    at = 0
    page = page or ""
    known: dict[tuple[str, str], tuple[str, int]] = {}
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        name = m[3]
        if name is None:  # comments and raw elements leave nothing; raw ones end a block
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if m[2] else links + 1
            continue
        flush()
        if name not in STRUCTURAL:
            continue
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    _, path, content, aside, _ = stack[i]
                    for x in stack[i:]:
                        if x[4] is not None:
                            x[4][2] = len(out)
                    del stack[i:]
                    out.append((0, path, content, aside, "/" + name))
                    break
            continue
        if m[4].endswith("/") and name in VOID:
            continue
        own = known.get((name, m[4]))
        if own is None:
            own = known[name, m[4]] = region(name, m[4])
        out.append((0, path, content, aside, own[0]))
        own_held = [aside, len(out), None] if own[1] == 1 and isinstance(aside, tuple) else None
        if own_held:
            held.append(own_held)
        stack.append((name, path, content, aside, own_held))
        path = f"{path}/{own[0]}"
        if own[1] == 1:
            content = 1
        elif own[1] == 2:
            aside = 1
        elif own[1] >= 3 and aside != 1:
            aside = (*(aside or ()), len(out))
            if own[1] == 4:
                hinted[len(out)] = [0, 0]
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)  # a tag that the page's end cuts off
        parts.append(rest[: cut.start()] if cut else rest)
    flush()
    unproven = {x for x, (size, proof) in hinted.items() if 2 * proof < size}
    if unproven:  # as if nothing had been hinted
        keep = lambda chain: tuple(x for x in chain if x not in unproven) or 0
        out = [(*t[:3], keep(t[3]), t[4]) if isinstance(t[3], tuple) else t for t in out]
        held = [[chain, a, b] for own, a, b in held if (chain := keep(own))]
    around: tuple = ()
    if held and not any(t[0] and t[2] and not t[3] for t in out):
        size, best = max(((sum(len(t[4]) for t in out[a:b] if t[0] and t[3] == chain), chain) for chain, a, b in held), key=lambda x: x[0])
        if size > sum(len(t[4]) for t in out if t[0] and not t[3]):
            around = best
    return [(*t[:3], int(any(x not in around for x in t[3])), t[4]) if isinstance(t[3], tuple) else t for t in out]


def token_key(token: tuple[int, str, int, int, str]) -> int:
    return xxhash.xxh3_64_intdigest(f"{token[0]}\n{token[1]}\n{token[4]}") >> 1


def path_key(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) >> 1


def occurrences(pages: DataFrame) -> DataFrame:
    """One row for each host and token: sums that identify its occurrence vector, and what it is.

    ``pages, times``: pages that have it, occurrences; ``v1, v2``: hashes of (page, count) summed;
    ``places``: positions summed; ``chars``: characters of text summed; ``head_low`` to ``tail_high``: bounds of
    a text's distance from the first and the last text of the page's content.  Tokens of a batch are added up first.
    """
    schema = "host string, token long, what int, path long, content int, aside int, pages long, times long, v1 long, v2 long, places double, chars long, head_low long, head_high long, tail_low long, tail_high long"
    bounds = {"head_low": F.min, "head_high": F.max, "tail_low": F.min, "tail_high": F.max}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, int], list] = {}
            for page_id, host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own: dict[int, list] = {}
                inside = 0
                for place, token in enumerate(parse(page.as_py())):
                    key = token_key(token)
                    if key in own:
                        own[key][1] += 1
                    else:
                        own[key] = [token, 1, place, inside, 0]
                    own[key][4] = inside
                    inside += token[0] == 1 and token[2] == 1 and not token[3]
                own[0] = [(2, "", 0, 0, ""), 1, 0, 0, 0]
                for key, (token, times, place, head, last) in own.items():
                    v = xxhash.xxh3_64_intdigest(f"{page_id} {times}")
                    s = sums.setdefault((host, key), [token[0], path_key(token[1]), token[2], token[3], 0, 0, 0, 0, 0.0, 0, head, head, inside - last, inside - last])
                    for i, x in enumerate((1, times, v >> 33, v & 0x7FFFFFFF, place, len(token[4]) * token[0])):
                        s[4 + i] += x
                    s[10:] = min(s[10], head), max(s[11], head), min(s[12], inside - last), max(s[13], inside - last)
            if sums:
                rows = [(*k, *s) for k, s in sums.items()]
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.float64(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in schema.split(", ")])

    same = [F.first(x).alias(x) for x in ("what", "path", "content", "aside")]
    found = pages.mapInArrow(run, schema)
    return found.groupBy("host", "token").agg(*same, *(F.sum(x).alias(x) for x in ("pages", "times", "v1", "v2", "places", "chars")), *(f(x).alias(x) for x, f in bounds.items()))


NESTED = "host string, skeleton array<long>, fixed array<long>, blocks array<long>"


def templates(tokens: DataFrame, share: float, least: int) -> DataFrame:
    """Per host: ``skeleton`` (template tags in order, nested classes in their places), ``fixed`` (template
    texts) and ``blocks`` (template texts in an article or main element).

    A host's template tokens are on ``share`` of its pages, so there are at most 1 / share times as many as
    tokens in its average page: a group is bounded by the length of pages, not by their number.
    """
    hosts = tokens.where("token = 0").select("host", F.col("pages").alias("of"))
    often = tokens.where("token <> 0").join(hosts, "host").where((F.col("pages") >= F.col("of") * share) & (F.col("pages") >= least))

    def nest(group: pa.Table) -> pa.Table:
        classes: dict[tuple, list] = {}
        rows = group.to_pylist()
        for r in rows:
            classes.setdefault((r["pages"], r["times"], r["v1"], r["v2"]), []).append((r["places"] / r["pages"], r["token"], r["what"]))
        # the class of most pages is the root; others are nested where their first token stands
        ordered = sorted(classes.items(), key=lambda c: (-c[0][0], -len(c[1]), c[0]))
        tree = [sorted(members) for _, members in ordered if len(members) >= 2 or members[0][2] == 1]
        template: list[tuple] = []
        for members in tree:
            low, high = members[0][0], members[-1][0]
            gap = [x for x in template if low < x[0] < high]
            if not template or not gap or any(a <= low and high <= b for a, b in zip([x[0] for x in template], [x[0] for x in template[1:]])):
                template = sorted(template + members)
            else:  # not between two neighbours: the class interleaves, only its texts count
                template = sorted(template + [m for m in members if m[2] == 1])
        tagged = {c for c, members in classes.items() if any(what == 0 for _, _, what in members)}
        placed = {
            r["token"]
            for r in rows
            if r["pages"] >= LEAST_INSIDE and ((r["pages"], r["times"], r["v1"], r["v2"]) in tagged or r["head_low"] == r["head_high"] or r["tail_low"] == r["tail_high"])
        }
        inside = {r["token"] for r in rows if r["what"] == 1 and r["content"] == 1}
        fixed = [t for _, t, what in template if what == 1]
        lists = [[t for _, t, what in template if what == 0], [t for t in fixed if t not in inside], [t for t in fixed if t in inside and t in placed]]
        return pa.Table.from_arrays([pa.array([rows[0]["host"]], pa.string()), *(pa.array([x], pa.list_(pa.int64())) for x in lists)], names=["host", "skeleton", "fixed", "blocks"])

    columns = ["host", "token", "what", "content", "pages", "times", "v1", "v2", "places", "head_low", "head_high", "tail_low", "tail_high"]
    return often.select(columns).groupBy("host").applyInArrow(nest, NESTED)


def in_order(keys: list[int], skeleton: list[int]) -> bool:
    """Whether the template's tags that the page has come in the template's order."""
    first: dict[int, int] = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    places = [first[k] for k in skeleton if k in first]
    return all(a < b for a, b in zip(places, places[1:]))


def slots_text(page: str | None, skeleton: list[int] | None = None, fixed: list[int] | None = None, blocks: list[int] | None = None) -> str:
    """What the slots of a page hold under a host's template; without one, all that isn't in an aside."""
    tokens = parse(page, frozenset((*(fixed or ()), *(blocks or ()))))
    texts = [t for t in tokens if t[0] == 1 and not t[3]]
    inside = [t for t in texts if t[2]]
    texts, template = (inside, set(blocks or ())) if inside else (texts, set(fixed or ()))
    if template and (inside or in_order([token_key(t) for t in tokens if t[0] == 0], skeleton or [])):
        slots = [t for t in texts if token_key(t) not in template]
        if 2 * sum(len(t[4]) for t in slots) >= sum(len(t[4]) for t in texts) if inside else slots:
            texts = slots
    return " ".join(t[4] for t in texts)


def extract_text(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Null and empty pages give an empty text; a null URL belongs to the host without a name; repeated rows
    and null ids are kept; other columns, whatever their names, are not read; an empty table gives no rows.  Character references are decoded, white space in a
    block becomes one space, and blocks are joined by one in page order.
    """
    spark = pages.sparkSession
    work = Workspace(spark, "html")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    tokens = work.table("tokens", occurrences(rows.select("page_id", "host", "html")).where(f"pages >= {least_pages} or token = 0"))
    found = work.table("templates", templates(tokens, share, least_pages))
    work.drop("tokens")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch.column(i).to_pylist() for i in (3, 4, 5)]
            texts = [slots_text(page.as_py(), *own) for page, *own in zip(batch.column(2), *c)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "skeleton", "fixed", "blocks")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
