import hashlib
import random
import re

from ledgerloom.llm import pii as P

SCHEMA = "doc_id long, text string, row long, kind int"


def plain_base(text):
    """The contract's patterns as they stand."""
    text, out = text or "", []
    for kind, pattern in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for i, d in enumerate(reversed(digits))) % 10 == 0
            ok = (True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")), 12 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15)[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_against_the_plain_patterns():
    rng = random.Random(2)
    bits = ["@", ".", "a", "b.c", "1", "25", "256", " ", "-", "+", "(", ")", "4242424242424242", "4242 4242 4242 4242", "+1 (212) 555-0100", "x@y.z", "1.2.3.4", "0", "%", "é", "\n", "４"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert P.base_spans(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    for c in ("a", "1", "@", ".", "1.", "+1", "1 ", "a@", "-"):
        P.occurrences(text := c * 200_000, P.base_spans(text))


def contextual():
    rng = random.Random(3)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    docs = [(i, f"Some text. E-mail: {name()}@{name()}.org and more words {rng.randint(1, 99)} here") for i in range(30)]
    docs += [(100 + i, f"call us on phone: +1 (212) 555-{1000 + i} today") for i in range(30)]
    docs += [(200, "E-mail: jo(at)site.org and so"), (201, "E-mail: kim.2[at]host and so"), (202, "phone: 212-555-0199 today"), (203, "E-mail: nothing to see"), (204, "version 2.0 words 17 here")]
    return docs + [(205, None), (206, ""), (None, "E-mail: null@id.org"), (207, "é " * 50_000 + "phone: 99-88-77 now"), (208, "copy a@b.cd"), (208, "copy a@b.cd")]


def test_contexts_find_unseen_identifiers(spark):
    docs = contextual()
    rows = P.personal_data(spark.createDataFrame([(*d, 5, 6) for d in docs], SCHEMA)).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        assert [(s.start, s.kind, s.end) for s in r.base] == plain_base(texts[r.doc_id])
    added = {r.doc_id: [(P.KINDS[s.kind], texts[r.doc_id][s.start : s.end]) for s in r.added] for r in rows}
    assert added[200] == [("email", "jo(at)site.org")]
    assert added[201] == [("email", "kim.2[at]host")]
    assert added[202] == [("phone", "212-555-0199")]
    assert added[207] == [("phone", "99-88-77")]
    assert not any(v for k, v in added.items() if k not in (200, 201, 202, 207))


def test_scores_against_brute_force(spark):
    rng = random.Random(7)
    seen = [(rng.choice([-1, -1, 0, 1]), f"v{rng.randint(0, 60)}", f"p{rng.randint(0, 12)}") for _ in range(400)]
    seen += [(0, f"s{i}", "good") for i in range(12)] + [(-1, "new", "good"), (-1, "new", "other")] + [(0, f"s{i}", "other") for i in range(7)] + [(-1, "s1", "good")] * 50
    edges = {}
    for kind, value, pattern in seen:
        edges[pattern, value] = max(kind, edges.get((pattern, value), -1))
    known = {(v, k): 1.0 for (_, v), k in edges.items() if k >= 0}
    belief = dict(known)
    for _ in range(P.ROUNDS):
        scores = {}
        for p in {p for p, _ in edges}:
            values = [v for q, v in edges if q == p]
            for kind in (0, 1):
                total = sum(belief.get((v, kind), 0) for v in values)
                if sum(belief.get((v, kind), 0) == 1 for v in values) >= P.LEAST_SEEDS and total / (len(values) + 1) >= P.LEAST_CONFIDENCE:
                    scores[p, kind] = total / (len(values) + 1)
        belief = dict(known)
        for (p, v), k in edges.items():
            for (q, kind), c in scores.items():
                if p == q and k < 0 and known.get((v, kind)) is None:
                    belief[v, kind] = max(c, belief.get((v, kind), 0))
    got = P.believed_patterns(spark.createDataFrame(seen, "kind int, value string, pattern string")).collect()
    assert {(r.pattern, r.kind): round(r.confidence, 9) for r in got} == {k: round(c, 9) for k, c in scores.items()}
    assert ("good", 0) in scores


def test_empty_table(spark):
    assert P.personal_data(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = P.op1_pii(spark, path).collect()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        names = [f"{P.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r.spans.split(","))


def test_thousands_of_digits_in_a_part_of_an_address():
    from ledgerloom.llm.pii import base_spans

    assert [s for s in base_spans("0" * 5000 + "1.2.3.4") if s[1] == 1] == [(0, 1, 5007)]
    assert [s for s in base_spans("9" * 5000 + ".2.3.4 and 0.0.0.0") if s[1] == 1] == [(5011, 1, 5018)]
