import re
from collections import defaultdict

import pytest

from loanlens.llm import line_dedup as L


def brute(rows, min_sites):
    """(doc_id, text) -> (clean text, removed) for (doc_id, text, site) rows."""
    sites, first = defaultdict(set), {}
    ids = defaultdict(set)
    for doc_id, text, site in rows:
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            if re.search(r"[^\x20\x09-\x0D]", line):
                if site is not None:
                    sites[line].add(site)
                place = (doc_id is not None, doc_id or 0, text, i)
                ids[line].add(place)
                first[line] = min(first.get(line, place), place, key=lambda p: p[:2])
    out = {}
    for doc_id, text, _ in rows:
        if text is None:
            out[doc_id, text] = (None, 0)
            continue
        kept = []
        for i, line in enumerate(text.split("\n")):
            place = (doc_id is not None, doc_id or 0, text, i)
            earliest = min(p[:2] for p in ids[line]) if line in ids else None
            alone = [p for p in ids.get(line, ()) if p[:2] == earliest]
            if len(sites[line]) >= min_sites and place not in alone:
                continue
            kept.append(line)
        out[doc_id, text] = ("\n".join(kept), len(text.split("\n")) - len(kept))
    return out


def test_equals_brute_force(docs_of, prose):
    common = [prose(100 + i, 9) for i in range(4)]
    rows = []
    for i in range(40):
        lines = prose(i, 40).split("\n")
        for k, line in enumerate(common):
            if i % (k + 2) == 0:
                lines.insert(k, line)
        rows.append((i, "\n".join(lines), f"site{i % (3 + i % 5)}"))
    rows += [(40, "", "a"), (41, None, "b"), (42, "\n\n", "c"), (43, common[0], None)]
    expected = brute(rows, 5)
    got = L.line_dedup(docs_of(rows)).select("row.doc_id", "row.text", "clean", "n_removed").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.clean, r.n_removed) == expected[r.doc_id, r.text], r.doc_id
    assert sum(r.n_removed for r in got) > 20


@pytest.mark.parametrize("n_sites", [4, 5, 6, 400, 401])
def test_threshold_is_exact_near_and_far(docs_of, n_sites):
    """Near the threshold the exact count decides, for few and for many sites."""
    threshold = 5 if n_sites < 10 else 401
    rows = [(i, f"the same line\nown line {i}", f"site{i % n_sites}") for i in range(2 * n_sites)]
    got = L.line_dedup(docs_of(rows), min_sites=threshold).selectExpr("sum(n_removed) as n").first().n
    assert got == (2 * n_sites - 1 if n_sites >= threshold else 0)


def test_first_place_stays_whole(docs_of, prose):
    text = prose(3, 60)
    rows = [(i, text, f"s{i}") for i in range(8)]
    got = {r.doc_id: r.clean for r in L.line_dedup(docs_of(rows)).select("row.doc_id", "clean").collect()}
    assert got[0] == text and all(got[i] == "" for i in range(1, 8))


def test_awkward_rows(docs_of, awkward):
    docs = docs_of(awkward)
    got = L.line_dedup(docs, min_sites=2)
    assert got.count() == len(awkward)
    assert got.select("row.*").columns == docs.columns
    by_text = {(r.doc_id, r.text): r for r in got.select("row.doc_id", "row.text", "clean", "n_lines", "n_removed").collect()}
    assert by_text[3, None].clean is None and by_text[3, None].n_lines == 0
    assert by_text[4, ""].clean == "" and by_text[4, ""].n_lines == 1


def test_empty_table(docs_of):
    assert L.line_dedup(docs_of([])).count() == 0
