import re

from loanlens.llm import license_scan as S


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, templates=S.TEMPLATES, threshold=S.THRESHOLD):
    ws = words(text)
    places = [(i, label) for p, label in S.PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    labels, best = {label for _, label in places}, 0.0
    base = sorted(labels)
    for block in re.split(r"\n[ \t\r]*\n", text or ""):
        tokens, matched = set(words(block)), []
        for label, texts in templates.items():
            for t in texts:
                need = set(words(t))
                share = len(tokens & need) / len(need)
                if share >= threshold:
                    matched.append((label, t, need, share))
        for label, t, need, share in matched:
            # another label's template that shares as many words as one of both needs, and fits better
            better = any(
                other != label and len(need & its) >= min(S.needed_words(len(its), threshold), S.needed_words(len(need), threshold))
                and len(its ^ tokens) < len(need ^ tokens)
                for other, _, its, _ in matched
            )
            if not better or f" {' '.join(words(t))} " in f" {' '.join(words(block))} ":
                labels.add(label)
                best = max(best, share)
    starts = [i for i, _ in places]
    return (
        len(ws), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(base), ",".join(sorted(labels)), 1.0 if places else best,
    )


def _check(docs_of, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = S.license_scan(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[1:7]) + (round(r[7], 9),) == (lambda b: b[:6] + (round(b[6], 9),))(brute(texts[r[0]])), r
    return got


def test_equals_brute_force(docs_of, prose, awkward):
    texts = [t for _, t in awkward]
    for i, (label, variants) in enumerate(sorted(S.TEMPLATES.items())):
        for t in variants:
            some = t.split(" ")
            texts += [t, prose(i, 30) + "\n\n" + t.upper() + "\n\n" + prose(i + 50, 30)]
            texts += [" ".join(some[: int(len(some) * part)]) for part in (0.5, 0.7, 0.8, 0.9)]
            texts.append("\n \t\n".join([" ".join(some[: len(some) // 2]), " ".join(some[len(some) // 2 :])]))
    texts += ["MIT LICENSE. AP\u0041CHE L\u0130CENSE, wor\u212a WOR\u212a mit License", "MIT License mit license, the Apache License! GNU General public LICENSE", "mit\nlicense mit  license", "license mit"]
    got = _check(docs_of, texts)
    assert {label for r in got for label in r["labels"].split(",") if label} == set(S.TEMPLATES)


def test_every_block_is_found(docs_of, spark):
    template = S.TEMPLATES["isc"][0]
    docs = docs_of([(1, f"{template}\n\nother words\n\n{template} and more")])
    rows = S.template_matches(docs).collect()
    assert sorted(r["block"]["number"] for r in rows) == [0, 2] and {r["label"] for r in rows} == {"isc"}


def test_prefixes_are_the_rarest_words():
    index = S.prefix_index({"x": ("a b c d e",)}, {"a": 9, "b": 1, "c": 5, "d": 0, "e": 7}, 0.8)
    assert [row[0] for row in index] == ["d", "b"] and index[0][4] == 4


def test_empty_table(docs_of):
    assert S.license_scan(docs_of([])).count() == 0


def test_near_templates_are_told_apart(docs_of, prose):
    expected = {
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY 4.0.": "cc-by",
        "This text is licensed under CC BY 4.0, see there.": "cc-by",
        "Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "Creative Commons Attribution 4.0 International License": "cc-by",
        "Text: Licensed under CC BY 4.0. Figures: Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Licensed under CC BY 4.0.\n\nLicensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        S.TEMPLATES["isc"][0]: "isc",
        S.TEMPLATES["mit"][0]: "mit",
        "none of them": "",
    }
    rows = [(i, f"{prose(i, 20)}\n\n{t}\n\n{prose(i + 50, 20)}") for i, t in enumerate(expected)]
    got = S.license_scan(docs_of(rows)).collect()
    assert {r.doc_id: r.labels for r in got} == dict(enumerate(expected.values()))


def test_every_template_has_its_label_alone(docs_of, prose):
    """Each notice between other text gets its label; half of its words replaced, none."""
    every = [(label, t) for label, texts in sorted(S.TEMPLATES.items()) for t in texts]
    whole = [f"{prose(i, 20)}\n\n{t}\n\n{prose(i + 90, 20)}" for i, (_, t) in enumerate(every)]
    halves = [" ".join(w if i % 2 else f"other{i}" for i, w in enumerate(words(t))) for _, t in every]
    got = {r.doc_id: r for r in _check(docs_of, whole + halves)}
    for i, (label, t) in enumerate(every):
        base = [x for x in got[i].base_labels.split(",") if x]
        assert got[i].labels == ",".join(sorted({label, *base})), t
        assert got[i + len(every)].labels == "", t


def test_whole_licenses(docs_of):
    """All paragraphs of one license in one document: its label, and that of the license it is made from."""
    labels = sorted(S.TEMPLATES)
    got = _check(docs_of, ["\n\n".join(S.TEMPLATES[label]) for label in labels])
    assert {labels[r.doc_id]: set(r.labels.split(",")) - set(r.base_labels.split(",")) - {labels[r.doc_id]} for r in got} == {
        label: set() for label in labels
    }
