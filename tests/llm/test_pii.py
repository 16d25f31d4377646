import hashlib
import random
import re

from corpusmill.llm import pii


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    text, out = text or "", []
    for k, (name, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[name]
            if ok:
                out.append((m.start(), k, name, m.end()))
    return [(n, s, e) for s, _, n, e in sorted(out)]


def texts():
    rng = random.Random(4)
    out = [
        None, "", "a@b.c@d.e", "a@b.cd+e@f.g x@y", "é😀 a.b@c-d.e.f, 4111 1111 1111 1111", "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.1 1.2.3", "+1 (988) 555-2485. +12345678 +1--------2",
        "1" * 3000, "1-" * 4000 + "1", "a" * 20000, "a." * 5000 + "@", "4111-1111-1111-1111 4111111111111112", "1.1.1.1" * 50,
    ]
    for _ in range(400):
        out.append("".join(rng.choice(["a", "@", ".", "1", "4", "2", "255", "+", "-", " ", "(", ")", "é", "😀", "b@c.d", "4111111111111111", "+1 555 123 4567", "\n"]) for _ in range(rng.randint(0, 40))))
    return out


def test_base_spans_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a@b.c", None), (0, None, None)]
    out = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    for i, t, _ in rows[:-2]:
        want, r = base(t), by[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(n == k for n, *_ in want) for k in ("email", "ip", "card", "phone")), t[:80]
        text = ",".join(f"{n}:{s}:{e}" for n, s, e in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (t, text, r.spans)
        assert [x for x in r.spans.split(",") if x.split(":")[0] in ("email", "ip", "card", "phone")] == [x for x in text.split(",") if x] or not text


def test_added_kinds(spark):
    cases = [
        ("pay to GB82 WEST 1234 5698 7654 32 now", "iban:7:34"), ("pay to GB83 WEST 1234 5698 7654 32 now", ""), ("DE89370400440532013000", "iban:0:22"),
        ("My SSN is 219-09-9999.", "ssn:10:21"), ("part 219-09-9999", ""), ("call (212) 555-0123", "local_phone:5:19"), ("x 212 555-0123", ""),
        ("219-09-9999 is my ssn", "ssn:0:11"), ("212 555-0123 (phone)", "local_phone:0:12"), ('é token = "04dbebab91ab85687d33" x', "secret:2:31"),
        ("API_KEY:abcdef0123456789abcdef; broken token = 1234567890123456789", "secret:0:30"), ("password=aaaaaaaaaaaaaaaaaaaa1 tokens = abcdef0123456789abcdef", ""),
    ]
    rows = spark.createDataFrame(list(enumerate(t for t, _ in cases)), "doc_id long, text string")
    out = pii.personal_data(rows, with_spans=True).orderBy("doc_id").collect()
    got = [",".join(x for x in r.spans.split(",") if x.split(":")[0] in ("iban", "ssn", "local_phone", "secret")) for r in out]
    assert got == [w for _, w in cases]
    assert all(s["score"] > pii.LEAST_SCORE for r in out for s in r.found)


def test_running_sums_and_empty_table(spark):
    rows = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 2, 3, 17, 1000)], "a array<bigint>")
    for a, s in rows.select("a", pii._running(rows["a"])).collect():
        assert s == [sum(a[: i + 1]) for i in range(len(a))]
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []
