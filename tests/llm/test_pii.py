import hashlib
import re

from pyspark.sql import functions as F

from tessella.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    found = sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], (text or "") if kind != "email" or "@" in (text or "") else "") if valid(kind, m[0]))
    listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)
    return [sum(k == i for _, k, _ in found) for i in range(4)], hashlib.sha256(listed.encode()).hexdigest(), listed


ODD = [
    "a@b.c_d@e.f and x@y@z.w a@b..c @x.y a.b%c+d@e-f.g.h.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3 300.300.300.300.1", "4111 1111-1111 1111 x 4111111111111111-4111111111111111",
    "+1 (234) 567-8901 +12 +1..........2 +1 234 567 890 123 456 789 0 ++4912345678 +49 30 1234567)", "é😀 a@b.cd 😀 +1 (234) 555-0000", "1 2 3 4 5 6 7 8 9 0 1 2 3", "9" * 5000, "a" * 3000 + "@", "a@b" + ".c" * 8000, "1-2 3--4 " * 50, "",
]


def test_base_spans_equal_brute_force(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([*enumerate(ODD), (99, None), (None, "a@b.cd"), (1, ODD[1])], "doc_id long, text string")
    for table in (docs, odd, odd_docs):
        want = sorted((str(r.doc_id), *brute(r.text)[0], brute(r.text)[1]) for r in table.collect())
        rows = pii.find(table).collect()
        assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows) == want
    texts = {i: t for i, t in enumerate(ODD)}
    for r in pii.find(odd.where("doc_id < 50")).collect():
        base = brute(texts[r.doc_id])[2]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        starts = [int(s.split(":")[1]) for s in r.spans.split(",") if s]
        assert starts == sorted(starts)
    assert pii.find(no_docs).count() == 0


def test_reliabilities_find_the_bad_labeler():
    # Three labelers agree with the truth 90 % of the time, one is a coin.
    import numpy as np

    rng = np.random.default_rng(8)
    truth = rng.random(4000) < 0.4
    seen = {}
    for t in truth:
        v = tuple(int(t) if rng.random() < 0.9 else int(not t) for _ in range(3)) + (int(rng.random() < 0.5),) + (-1,) * 5
        seen[v] = seen.get(v, 0) + 1
    accuracy, q = pii.reliabilities(sorted(seen.items()))
    assert all(abs(accuracy[:3] - 0.9) < 0.04) and accuracy[3] == 0.55
    right = sum(n for (v, n), x in zip(sorted(seen.items()), q, strict=True) if (x > 0.5) == (sum(v[:3]) >= 2))
    assert right > 0.97 * 4000


def test_method_adds_secrets_and_leaves_plain_text(spark):
    rows = [(i, f'some words then token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and more') for i in range(30)]
    rows += [(100 + i, f"plain words on page {i} of version {i}.{i} with {i * 1234567} things") for i in range(30)]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "secret:25:65" for i in range(30))
    assert all(got[100 + i] == "" for i in range(30))


def test_redact(spark, sf, odd_docs, no_docs):
    rows = [(1, "mail a@b.cd or +1 (234) 555-0000 é 1.2.3.4!", 5), (2, None, None), (3, "plain", 5)]
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert got == {1: ("mail [email] or [phone] é [ip]!", 31), 2: (None, None), 3: ("plain", 5)}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert pii.find(out).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert out.where(F.length("text") != F.col("n_chars")).count() == 0
    assert pii.redact(odd_docs).count() == odd_docs.count() and pii.redact(no_docs).count() == 0


def test_long_runs_are_candidates(spark):
    # No digit runs that could be card numbers.
    key = "".join(f"{chr(97 + i % 26)}{i * i % 10}" for i in range(4000))
    rows = [(i, f"some words then token = {key[: 500 + 100 * i]} and more") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert all(got[i] == f"secret:24:{24 + 500 + 100 * i}" for i in range(60))
    assert all(r.text == "some words then token = [secret] and more" for r in pii.redact(docs, size_col=None).collect())
    texts = [("1" * 40,), ("12 34 " + "5" * 5000,), ("1 2 " * 20_000 + "3x",)]
    found = F.regexp_extract_all("text", F.lit(pii.CANDIDATES), F.lit(0))
    runs = [r[0] for r in spark.createDataFrame(texts, "text string").select(found).collect()]
    assert runs[0] == ["1" * 40] and runs[1] == ["12 34 " + "5" * 5000] and len(runs[2]) > 1000


def test_many_matches_in_one_text(spark):
    """More matches than a chunk holds, of every kind; some overlap."""
    line = "x a{0}@b.cd y 10.0.{0}.7, +1 (234) 555-{0:04} token = k3y{0}aB9k3yaB9k3yaB9k3yaB9k3yaB9 4111 1111 1111 1111;"
    text = "\n".join(line.format(i) for i in range(150))
    docs = spark.createDataFrame([(1, text, len(text)), (2, "+1 234 4111 1111 1111 1111 z", 3)], "doc_id long, text string, n_chars long")
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert [rows[1][f"n_{k}"] for k in pii.KINDS] == brute(text)[0] and rows[1].base_sha256 == brute(text)[1]
    assert set(brute(text)[2].split(",")) <= set(rows[1].spans.split(",")) and rows[1].n_spans == len(rows[1].spans.split(",")) >= 600
    for r in pii.redact(docs).collect():
        source, at, out = text if r.doc_id == 1 else "+1 234 4111 1111 1111 1111 z", 0, ""
        for kind, a, b in (s.split(":") for s in rows[r.doc_id].spans.split(",") if s):
            if int(a) >= at:
                out += source[at : int(a)] + f"[{kind}]"
            at = max(at, int(b))
        assert r.text == out + source[at:] and r.n_chars == len(r.text)


def test_added_spans_equal_brute_force(spark):
    """Spans are the fixed patterns' and the candidates whose traits the model takes, unless they overlap those."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    table = pii.annotated(docs, "text", "p").select("doc_id", "text", "p_base", "p_loose").cache()
    model = pii.fit(table, "p_loose")
    assert model and all(0 <= p <= 1 for p in model.values())
    rank = {"email": "email", "quad": "ip", "plus": "phone", "digits": "number", "mixed": "secret"}
    order = [*pii.KINDS, *pii.MORE_KINDS]
    want = {}
    for r in table.collect():
        base = [(s.start, s.kind, s.end) for s in r.p_base]
        more = [(s.start, order.index(rank[s["shape"]]), s.end) for s in r.p_loose if model[s.traits] >= 0.5 and not any(a < s.end and s.start < e for a, _, e in base)]
        assert all(r.text[a:e].strip() for a, _, e in more)
        want[r.doc_id] = ",".join(f"{order[k]}:{a}:{e}" for a, k, e in sorted(base + more))
    assert {r.doc_id: r.spans for r in pii.find(docs).collect()} == want
