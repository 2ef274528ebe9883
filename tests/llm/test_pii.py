import random
import re

import pytest

from courtline.llm.pii import KINDS, Settings, forms, spans

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(FORMS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((k, m.start(), m.end()))
    return out


TEXTS = [
    "Mail a.b@c.de, x@y and z@q.w.e. end", "a@b.c_d@e.f@g.h", "@@ a@b..c a@-.-", "é🙂 u@v.w 🙂 1.2.3.4", "1.2.3.45.6.7.8 9.9.9 0001.2.3.4",
    "256.1.1.1 1.1.1.256 00000000000000000000255.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111  1111", "+1 (988) 555-2485 +44 ()",
    "+1+2 34567890123", "+12345678 +123456789012345 6", "tel:+1.2.3.4.5.6.7.8.9", None, "", " ", "9" * 400, "a" * 3000 + "@b.c", "+" + " " * 500,
    "1" + ".1" * 500, "a@b" + ".c" * 800, "x@y.z,4111111111111111;10.0.0.1",
]


def found(df):
    return {(r.id, tuple((s.kind, s.start, s["end"]) for s in r.base)) for r in df.collect()}


def test_fixed_forms_against_the_plain_patterns(docs):
    rng = random.Random(1)
    alphabet = "01245.9@ab-+ ()é\n_,"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 120))) for _ in range(400)]
    rows = list(enumerate(texts))
    assert found(spans(docs(rows))) == {(i, tuple(brute(x))) for i, x in rows}


def test_very_long_texts(docs):
    rows = [(1, "1 2 3 " * 20_000), (2, "8" * 120_000), (3, "b" * 120_000), (4, "10.0.0.1 a@b.cd " * 4_000), (5, "+" * 50_000)]
    # The plain patterns would take quadratic time on the long runs, in which nothing is valid.
    want = {4: tuple(brute(rows[3][1]))}
    assert found(spans(docs(rows))) == {(i, want.get(i, ())) for i, _ in rows}


def test_contexts_of_known_values_find_values_of_other_forms(docs):
    rng = random.Random(2)
    rows = [(i, f"filler words {i} here contact: u{i}@mail.org today and more") for i in range(30)]
    rows += [(100 + i, f"dial phone: +1 (988) 555-{2000 + i} now please") for i in range(30)]
    rows += [(200, "contact: jane[at]mail4567.org today"), (201, "phone: 988-555-777 now"), (202, "invoice 12345678 paid now"),
             (203, "contact: u3@mail.org today")]
    rng.shuffle(rows)
    got = {r.id: [(KINDS[s.kind], s.value) for s in r.found] for r in spans(docs(rows)).collect()}
    assert got[200] == [("email", "jane[at]mail4567.org")] and got[201] == [("phone", "988-555-777")]
    assert not got[202] and not got[203] and not any(got[i] for i in range(30))


@pytest.mark.parametrize("mark", [",", ".", ";", ")", "),"])
def test_marks_after_identifiers_leave_the_patterns_good(docs, mark):
    rows = [(i, f"contact: u{i}@mail.org{mark if i % 3 else ''} today") for i in range(60)]
    rows += [(100 + i, f"paid card: 4111 1111 1111 1111{mark} again{i}") for i in range(5)]
    rows += [(200 + i, f"dial phone: +1 (988) 555-{2000 + i}{mark if i % 3 else ''} now") for i in range(60)]
    rows += [(300, "contact: jane[at]mail4567.org today"), (301, "phone: 988-555-777 now"), (302, "x1234@ +1 (988) 555-2000, 98765")]
    parts = {r.id: r for r in forms(docs(rows)).collect()}
    for i, x in rows:
        spans_ = [(a, b) for _, a, b in brute(x)]
        want = [(m.start(), m.end()) for m in re.finditer(r"\S*[0-9@]\S*", x) if "@" in m.group() or len(re.sub("[^0-9]", "", m.group())) >= 4]
        assert [(s.start, s["end"]) for s in parts[i].others] == [(a, b) for a, b in want if not any(c < b and a < d for c, d in spans_)]
    got = {r.id: [(KINDS[s.kind], s.value) for s in r.found] for r in spans(docs(rows)).collect()}
    assert got[300] == [("email", "jane[at]mail4567.org")] and got[301] == [("phone", "988-555-777")]


def test_a_context_of_anything_teaches_nothing(docs):
    rows = [(i, f"the u{i}@mail.org of") for i in range(20)] + [(50 + i, f"the {70000 + i} of") for i in range(20)]
    assert not any(r.found for r in spans(docs(rows)).collect())


def test_later_rounds_learn_from_found_values(docs):
    rows = [(i, f"mail to: u{i}@mail.org thanks") for i in range(20)]
    rows += [(100 + i, f"to: user{i}1234 thanks") for i in range(4)]
    rows += [(200 + i, f"handle= user{i % 4}1234 ok") for i in range(4)] + [(300 + i, f"handle= v{i}@mail.org ok") for i in range(8)]
    rows += [(400, "handle= zed98765 ok")]
    got = {r.id: [s.value for s in r.found] for r in spans(docs(rows), settings=Settings(rounds=3)).collect()}
    assert got[100] == ["user01234"] and got[400] == ["zed98765"]


def test_repeated_rows_and_empty_table(docs):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"), (None, None)]
    got = [(r.id, len(r.base), r.found) for r in spans(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, []), (1, 1, []), (None, 1, []), (None, 0, [])], key=str)
    assert spans(docs([])).collect() == []


@pytest.mark.parametrize("name", ["op8_pii", "op6_exact_dedup"])
def test_native_queries_run_no_python_in_the_executors(spark, name):
    from courtline.llm.queries import QUERIES
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
