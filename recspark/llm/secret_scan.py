"""Secret scan with multipart credential linking.

Base spans are reported on their own: ``assign`` (a keyword assigned a value of 8 or more characters), ``access`` (an access
identifier) and ``hex`` (a hexadecimal run of 32 or more characters).

Other parts are weak: a bare token of 20 or more characters that mixes cases and digits (``weak``, it may be a secret
key) and the address of a service (``endpoint``).  They are reported only when complementary parts
co-occur, by one of the rules in ``RULES``, of which the query takes ``any``:

``all``  a weak secret with an access identifier and an endpoint, both in its paragraph (text between empty lines) and within ``reach``
         characters of it.
``any``  a weak secret of a document with an access identifier, wherever both are, and the nearest endpoint in ``reach`` where there is one;
         or, the stricter rule, a weak secret of a document without an identifier that has an endpoint in its paragraph and within ``reach``
         (a part of the address itself is no secret beside it).

The interval join is made per document on the sorted spans, with binary searches over starts and ends, so a document with
many parts costs n log n; no pairs are listed and nothing is shuffled.  Every pattern is matched in time linear in the text.

Positions are code points, ends are exclusive.  Defined cases: a null or empty text has no spans; every row is scanned
on its own, so repeated rows, null ids and extra columns change nothing; a very long text is
scanned whole; spans of different kinds may overlap, those of one kind do not; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col

ship_by_value(__name__)

RESULT = "doc_id long, n_assign long, n_access long, n_hex long, n_linked long, base_sha256 string, spans string"
KINDS = ("assign", "access", "hex", "weak", "endpoint")  # their order among spans that start together

# The patterns of the base spans (fixed values); runs are matched whole and then measured.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # a greedy leftmost match is the maximal run
WEAK = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/=])"
# An endpoint is a URL, SCHEME{2,21} and ADDRESS, or a host name of dotted labels that ends in HOST_END.
ADDRESS = r"://[A-Za-z0-9.-]+(?::[0-9]{1,5})?[^\s\"'<>]*"
HOST_END = r"\.(?:amazonaws\.com|internal|local)\b"
HOST_START = r"\b(?=[a-z0-9-])"
SCHEME, HOST = "abcdefghijklmnopqrstuvwxyz0123456789+.-", "abcdefghijklmnopqrstuvwxyz0123456789.-"
BREAK = r"\n[ \t]*\n"
PLACE_PARTS = ("://", ".amazonaws.com", ".internal", ".local")  # every endpoint has one of them
RULES = ("all", "any")


def base_spans(text: str, patterns) -> list[tuple[int, int, str]]:
    assign, access, runs = patterns[:3]
    out = [(m.start(), m.end(), "assign") for m in assign.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in access.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in runs.finditer(text)]
    return out


def _host_segments(text: str, host_end) -> list[tuple[int, int, int]]:
    """(begin, place of the last ending, its stop) of every stretch of dotted labels, none of them empty, that has an ending.

    An ending looks to the left only as far as the ending before it, so the time is linear.
    """
    out, at, begin = [], 0, 0
    for m in host_end.finditer(text):
        end = m.start()
        before = len(text[at:end].rstrip(HOST))
        if before or at == 0:  # a new run of host characters
            at += before
            begin = at + (text[at] == ".")
        gap = text.rfind("..", at, end + 1)
        begin = gap + 2 if gap >= 0 else begin
        if begin < end:
            if out and out[-1][0] == begin:
                out.pop()
            out.append((begin, end, m.end()))
        at = end
    return out


def endpoints(text: str, address, host_end, host_start) -> list[tuple[int, int]]:
    """Spans of the endpoints of a text, leftmost first (a URL before a host name), without overlaps, in linear time.

    Both kinds are found from their rarest part (``://``, the ending) and extended to the left.
    """
    hosts = _host_segments(text, host_end)

    def url_from(pos, c):
        """The first URL that begins at ``pos`` or later; ``c``: where to look for ``://``."""
        while c >= 0:
            low = max(pos, c - 21)
            low += len(text[low:c].rstrip(SCHEME))
            start = next((p for p in range(low, c - 1) if "a" <= text[p] <= "z"), None)
            m = address.match(text, c) if start is not None else None
            if m:
                return start, m.end(), c
            c = text.find("://", max(c + 1, pos))
        return None

    def host_from(pos, k):
        for k in range(k, len(hosts)):
            begin, end, stop = hosts[k]
            m = host_start.search(text, max(begin, pos), end) if max(begin, pos) < end else None
            if m:
                return m.start(), stop, k
        return None

    out, url, host = [], url_from(0, text.find("://")), host_from(0, 0)
    while url or host:
        best = url if not host or url and url[0] <= host[0] else host
        out.append(best[:2])
        pos = best[1]
        if url and url[0] < pos:
            url = url_from(pos, url[2])
        if host and host[0] < pos:
            host = host_from(pos, host[2])
    return out


def compiled() -> list:
    return [re.compile(x) for x in (ASSIGN, ACCESS, HEX, WEAK, BREAK, ADDRESS, HOST_END, HOST_START)]


def linked_spans(text: str, base: list[tuple[int, int, str]], patterns, reach: int, rule: str = "all") -> list[tuple[int, int, str]]:
    """Weak secrets whose complementary parts co-occur by ``rule``, and the endpoints that they use."""
    access = sorted((a, b) for a, b, kind in base if kind == "access")
    if not access and (rule == "all" or not any(x in text for x in PLACE_PARTS)):
        return []
    weak_re, break_re, *place_res = patterns[3:]
    taken = {(a, b) for a, b, _ in base}
    weak = [m.span() for m in weak_re.finditer(text) if _mixed(m.group()) and m.span() not in taken]
    if not weak:
        return []
    places = endpoints(text, *place_res)
    if not places and (rule == "all" or not access):
        return []
    w, p, ids = (np.array(x, np.int64).reshape(-1, 2) for x in (weak, places, access))
    if access:
        w = w[~_inside(w, ids)]
    breaks = np.array([m.start() for m in break_re.finditer(text)], np.int64)
    scope = lambda x: np.searchsorted(breaks, x[:, 0], side="right")
    used, which = _nearest(w, scope(w), p, scope(p), reach)
    if rule == "any":
        if not access:
            used &= ~_inside(w, p)  # a part of an address is not a secret beside it
        ok = used | bool(access)
        if access:  # without an endpoint in its paragraph, one of another paragraph
            far, other = _nearest(w, np.zeros(len(w)), p, np.zeros(len(p)), reach)
            used, which = used | far, np.where(used, which, other)
    else:
        near, _ = _nearest(w, scope(w), ids, scope(ids), reach)
        ok = used = used & near
    return [(int(a), int(b), "weak") for a, b in w[ok]] + [(*places[k], "endpoint") for k in sorted(set(which[used].tolist()))]


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def _inside(spans: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether a span overlaps one of ``others`` (sorted, disjoint)."""
    if not len(others):
        return np.zeros(len(spans), bool)
    k = np.searchsorted(others[:, 0], spans[:, 1], side="left") - 1
    return (k >= 0) & (others[np.maximum(k, 0), 1] > spans[:, 0])


def _nearest(spans, scope, others, other_scope, reach: int):
    """Interval join: for each span, whether an interval of ``others`` of its scope lies within ``reach``, and the nearest one."""
    if not len(others):
        return np.zeros(len(spans), bool), np.zeros(len(spans), np.int64)
    after = np.searchsorted(others[:, 0], spans[:, 0])
    best, which = np.full(len(spans), reach + 1), np.zeros(len(spans), np.int64)
    for k, gap in ((after - 1, lambda k: np.maximum(0, spans[:, 0] - others[k, 1])), (after, lambda k: np.maximum(0, others[k, 0] - spans[:, 1]))):
        safe = np.clip(k, 0, len(others) - 1)
        d = np.where((k == safe) & (other_scope[safe] == scope), gap(safe), reach + 1)
        which, best = np.where(d < best, safe, which), np.minimum(best, d)
    return best <= reach, which


def scan_text(text: str, patterns, reach: int, rule: str = "all"):
    """(base spans, all spans), each sorted by start and kind."""
    order = lambda s: (s[0], KINDS.index(s[2]))
    base = sorted(base_spans(text, patterns), key=order)
    more = linked_spans(text, base, patterns, reach, rule)
    return base, sorted(base + more, key=order) if more else base


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _scanner(reach: int, rule: str):
    def scan(batches):
        patterns = compiled()
        for batch in batches:
            rows = []
            for text in batch["text"].tolist():
                base, spans = scan_text(text, patterns, reach, rule) if text else ((), ())
                n = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]] if base else [0, 0, 0]
                rows.append((*n, len(spans) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_linked", "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(object, na_value=None))
            yield out

    return scan


def scan_secrets(docs: DataFrame, reach: int = 400, id_col: str = "doc_id", text_col: str = "text", rule: str = "all") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(_scanner(reach, rule), RESULT)
