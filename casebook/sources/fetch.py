"""Fetching units of work: each gives (url, body, status, parameters) of its snapshots, and interprets only what it must.

A unit's answers are checked before any is kept, so that a soft error never becomes a snapshot.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import parse_qs, urlencode, urljoin, urlsplit, urlunsplit

from casebook.functions.dom import tree
from casebook.plans import decisions, judgments, statutes
from casebook.sources.policy import Client, Response

Snapshots = Iterator[tuple[str, bytes, int, dict]]
# The sources' addresses.
DEBATES = "https://sprs.parl.gov.sg/search/getHansardReport"
DEBATE_FILES = "https://sprs.parl.gov.sg/search/officialReport/getFile"
STATUTES, BROWSE = "https://sso.agc.gov.sg", "?PageSize=500&SortBy=Title&SortOrder=ASC"
JUDGMENTS = "https://www.elitigation.sg"
JUDGMENT_LISTING = JUDGMENTS + "/gd/Home/Index?Filter={filter}&YearOfDecision={year}&SortBy=Score&CurrentPage={page}"
DECISIONS = "https://www.pdpc.gov.sg"
DECISION_PATH = "/organisations/regulations-decisions/enforcement-decisions"


def ok(response: Response | None, what: str) -> Response:
    if response is None:
        raise RuntimeError(f"{what}: retries exhausted")
    if response.status != 200:
        raise RuntimeError(f"{what}: HTTP {response.status}")
    return response


def debates(payload: dict, client: Client, vernacular: bool = False) -> Snapshots:
    """A sitting's report; any other status, or an error without sections, means that there was no sitting."""
    day = datetime.strptime(payload["sitting_date"], "%Y-%m-%d").strftime("%d-%m-%Y")
    params = {"sittingDate": day}
    r = client.post_json(DEBATES, params)
    if r is None or r.status != 200 or (b'"errorCode"' in r.body and b'"takesSectionVOList"' not in r.body):
        return
    yield r.url, r.body, r.status, params
    try:
        listed = json.loads(r.body).get("vernacularList") or [] if vernacular else []
    except ValueError:
        listed = []
    for x in listed:
        f = client.post_json(DEBATE_FILES, {"id": x["vernacularID"], "type": "vernacular"}) if x.get("vernacularID") is not None else None
        if f is not None and f.status == 200 and f.body.startswith(b"%PDF"):
            yield f.url, f.body, f.status, {"kind": "vernacular", **params, **{k: x.get(k, "") for k in ("vernacularID", "vernacularTitle", "fileName")}}


def judgment_pages(payload: dict, client: Client) -> Snapshots:
    url = JUDGMENT_LISTING.format(**payload) if payload["kind"] == "listing" else urljoin(JUDGMENTS, payload["item"]["href"])
    r = ok(client.get(url), url)
    read = judgments.cards_of(r.text) if payload["kind"] == "listing" else judgments.read_page(r.text)
    if read["error"]:
        raise ValueError(read["error"])
    if payload["kind"] != "listing":
        found, listed = (judgments.CITATION.search(x or "") for x in (read["citation"], payload["item"]["citation"]))
        same = found and listed and [x.group(*range(1, 4)) for x in (found, listed)]
        if not same or [x.upper() for x in same[0]] != [x.upper() for x in same[1]]:
            raise ValueError("judgment citation differs from its listing")
    yield r.url, r.body, r.status, payload


def with_ids(url: str, ids: list[str]) -> str:
    parts = urlsplit(url)
    return urlunsplit((*parts[:3], urlencode({**parse_qs(parts.query), "ProvIds": ",".join(ids)}, doseq=True), ""))


def chunks(url: str, ids: list[str], longest: int = statutes.LONGEST_URL) -> list[list[str]]:
    out: list[list[str]] = []
    for x in ids:
        if out and len(with_ids(url, [*out[-1], x])) <= longest:
            out[-1].append(x)
        else:
            out.append([x])
    return out


def statute_pages(payload: dict, client: Client, versions: bool = False) -> Snapshots:
    """Listing pages (following their page links), or a statute's structure and its provisions, of all versions if asked."""
    if payload["kind"] == "listing":
        todo, seen = [STATUTES + payload["path"] + BROWSE], set()
        while todo:
            url = todo.pop(0)
            seen.add(url)
            r = ok(client.get(url), url)
            if (read := statutes.listing_of(r.text))["error"]:
                raise ValueError(read["error"])
            yield r.url, r.body, 200, {**payload, "page_url": url}
            links = [urljoin(STATUTES, a.attrs["href"]) for a in tree(r.text).find("a") if re.fullmatch(re.escape(payload["path"]) + r"/\d+" + re.escape(BROWSE), a.attrs.get("href", ""))]
            todo += [x for x in dict.fromkeys(links) if x not in seen and x not in todo]
        return

    def read(url: str) -> tuple[Response, dict, str]:
        r = ok(client.get(url), url)
        page = statutes.read_page(r.text)
        if page["error"]:
            raise ValueError(page["error"])
        return r, page, datetime.strptime(page["selected"], "%d %b %Y").strftime("%Y%m%d")

    iso = lambda d: f"{d[:4]}-{d[4:6]}-{d[6:]}"
    url = urljoin(STATUTES, payload["item"]["href"])
    r, page, current = read(url)
    timeline = [(x["day"], x["href"]) for x in page["timeline"]]
    yield r.url, r.body, 200, {**payload, "kind": "structure"}
    for start, href in timeline if versions else [(current, payload["item"]["href"])]:
        address, at = urljoin(STATUTES, href), page
        if start != current:
            r, at, shown = read(address)
            if shown != start:
                raise ValueError("another version was shown; it isn't taken instead")
            yield r.url, r.body, 200, {**payload, "kind": "structure"}
        ids = [x["anchor"] for x in at["toc"]]
        if not ids:
            raise ValueError("empty table of contents")
        end = next((iso(d) for d, _ in timeline if d > start), None)
        for n, some in enumerate(chunks(address, ids)):
            r, part, shown = read(with_ids(address, some))
            absent = sorted(set(some) - {x["anchor"] for x in part["pieces"]})
            if shown != start or absent:
                raise ValueError(f"provisions of another version, or absent: {absent}")
            yield r.url, r.body, 200, {**payload, "kind": "provisions", "requested_ids": some, "all_ids": ids, "version_start": iso(start), "version_end": end, "version_seq": 1 + [d for d, _ in timeline].index(start), "historical": start != current, "root_record": n == 0}


def decision_pages(payload: dict, client: Client) -> Snapshots:
    """The sitemap, a listing until its running count reaches its total, or a decision's page with its files."""
    if payload["kind"] == "sitemap":
        r = ok(client.get(DECISIONS + "/sitemap.xml"), "sitemap")
        if "<urlset" not in r.text:
            raise ValueError("sitemap without a set of addresses")
        yield r.url, r.body, 200, payload
        return
    if payload["kind"] == "listing":
        page = count = 0
        while True:
            page += 1
            r = ok(client.get(DECISIONS + "/api/listing-api", {"listingtype": "enforcement_decisions", "itemsperpage": decisions.PAGE_SIZE, "pathname": DECISION_PATH, "type": payload["collection"], "page": page, "sort": "oldest"}), "listing")
            got = json.loads(r.body)
            if not isinstance(got.get("data"), list) or not isinstance(got.get("totalItems"), int):
                raise ValueError("unexpected shape of a listing")
            yield r.url, r.body, 200, {**payload, "page": page}
            count += len(got["data"])
            if count >= got["totalItems"]:
                return
            if not got["data"]:
                raise ValueError("listing ended before its total")
    item = payload["item"]
    url = urljoin(DECISIONS, item["href"])
    r = client.get(url)
    if r is not None and r.status == 404:
        r = next((x for x in map(client.get, _candidates(payload, url)) if x is not None and x.status == 200 and _same(x.text, item)), r)
    r = ok(r, url)
    read = decisions.read_detail(r.text)
    if read["error"] or not read["content"].strip():
        raise ValueError(read["error"] or "decision without rich text")
    yield r.url, r.body, 200, {"kind": "detail", "item": item, "has_pdf": bool(read["links"])}
    for link in dict.fromkeys(urljoin(DECISIONS, x) for x in read["links"]):
        if urlsplit(link).hostname != urlsplit(DECISIONS).hostname:
            raise ValueError(f"a file on another host: {link}")
        f = ok(client.get(link), link)
        if not f.body.startswith(b"%PDF"):
            raise ValueError(f"not a PDF file: {link}")
        yield f.url, f.body, 200, {"kind": "pdf", "item": item, "detail_html": r.text, "detail_sha256": hashlib.sha256(r.body).hexdigest(), "detail_url": r.url}


def _candidates(payload: dict, url: str) -> list[str]:
    return [x for x in payload.get("sitemap_candidates", []) if x != url and urlsplit(x).hostname == urlsplit(DECISIONS).hostname]


def _same(markup: str, item: dict) -> bool:
    root = tree(markup)
    heading, published = root.first("h1"), root.first(cls="page-banner__date")
    return heading is not None and published is not None and heading.text() == " ".join(item["title"].split()) and published.text().removeprefix("Published on ") == item["date"]


SOURCES = {"hansard": debates, "sso": statute_pages, "elitigation": judgment_pages, "pdpc": decision_pages}
