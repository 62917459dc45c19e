"""Personal data and benchmark copies against brute force."""

import hashlib
import random
import re

import numpy as np

from lexmill.llm import decontaminate, pii, queries

SF = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(BASE[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in df.collect())


def expected(rows):
    out = []
    for d, t in rows:
        b = brute(t)
        digest = hashlib.sha256(",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in b).encode()).hexdigest()
        out.append((str(d), *(sum(x[3] == k for x in b) for k in pii.KINDS), digest))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, kind string, pattern int")


def test_base_spans_on_odd_texts(spark):
    rng = random.Random(2)
    rows = [
        (1, None), (2, ""), (None, "a@b.co"), (3, "😀 a@b.co_x@d.e.f 1.2.3.4.5.6.7.8 999.1.1.1 001.02.003.255"), (4, "4111 1111-1111 1111 4111111111111112 +1 (555) 123-4567x +12 +123456789012345678"),
        (5, "x@y@z.com .@a.b -@-.- a@b a@b. %+@1.2"), (5, "x@y@z.com .@a.b -@-.- a@b a@b. %+@1.2"), (6, "1" * 5000 + ".2.3.4"), (7, "a" * 5000 + "@b" + ".c" * 3000), (8, "+1 22 " * 700), (9, "12 34 " * 900), (10, "0.0.0.0 " * 600),
    ]
    rows += [(100 + i, "".join(rng.choice(["a@", "b.c", ".", "@", " ", "1", "23", "+4", "-", "(", ")", "x", "255", "é", "\n", "4111111111111111"]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    got = pii.report(frame(spark, rows))
    assert rows_of(got) == expected(rows)
    assert pii.report(frame(spark, rows).limit(0)).count() == 0


def test_query_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op5_pii(spark, SF)
    assert rows_of(got) == expected(rows)
    for r in got.collect():
        base = {f"{x[3]}:{x[0]}:{x[2]}" for x in brute(dict(rows)[r.doc_id])}
        assert base <= set(filter(None, r.spans.split(",")))


def test_contexts_discover_unseen_identifiers(spark):
    """Numbers after 'card' are cards, though their check digit is wrong; numbers after other words are not."""
    valid = ["4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117", "5105105105105100", "4222222222222220"]
    valid = [v for v in valid if luhn(v)] + ["4000056655665556", "5200828282828210"]
    rows = [(i, f"my card {v} was used") for i, v in enumerate(valid * 2)]
    rows += [(50, "lost card 4111111111111112 today"), (51, "build 4111111111111113 passed"), (52, "plain text"), (53, None)]
    got = {r.doc_id: r.spans for r in pii.report(frame(spark, rows)).collect()}
    assert got[50] == "card:10:26" and got[51] == "" and got[52] == "" and got[53] == ""


def test_contexts_discover_other_forms(spark):
    """A phone number without a plus sign, an address at a bare host and a key of an unknown format, beside words that
    stood beside seeds; the same forms beside other words stay."""
    rng = random.Random(4)
    hexes = ["".join(rng.choice("abcdef") + rng.choice("0123456789") for _ in range(20)) for _ in range(9)]  # no card in them
    rows = [(i, f"please call +1 (743) 555-{1000 + i} now") for i in range(9)]
    rows += [(20 + i, f"write to user{i}@host{i}.example.com today") for i in range(9)]
    rows += [(40 + i, f'api key = "{h}"') for i, h in enumerate(hexes)]
    rows += [(60, "you may call (743) 555-3824 at night"), (61, "please write to root@localhost or not"), (62, 'my key = "Zk93xQpL_77aQ-vv81Bb" is out'), (63, "room (743) 555-3824-1 is full")]
    rows += [(64, "see someone@somewhere in print"), (65, "part abcdefgh12345678ijkl fits"), (66, f"commit {hexes[0][::-1]} is bad"), (67, "x " * 5000 + "7 " * 5000)]
    got = {r.doc_id: r for r in pii.report(frame(spark, rows)).collect()}
    text = dict(rows)
    found = {d: [(k, text[d][int(a) : int(b)]) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)] for d, r in got.items()}
    assert found[60] == [("phone", "(743) 555-3824")] and found[61] == [("email", "root@localhost")] and found[62] == [("secret", "Zk93xQpL_77aQ-vv81Bb")]
    assert all(found[40 + i] == [("secret", h)] for i, h in enumerate(hexes)) and got[40].n_found == 1 == got[40].n_spans
    assert not any(found[d] for d in (63, 64, 65, 66, 67))


def table_score(a, b):
    """The whole table of a local alignment, cell by cell."""
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (1 if x == y else -0.5), h[i][j + 1] - 0.5, h[i + 1][j] - 0.5)
    return max(map(max, h))


def test_alignment_scores():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 15))] for _ in range(2))
        assert decontaminate.smith_waterman(np.array(a), np.array(b))[0] == table_score(a, b)


def test_contaminated_pairs(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [(i, [word() for _ in range(rng.randint(12, 50))]) for i in range(20)]
    rows, want = [(1, None), (2, "")], set()
    for n in range(120):
        body = [word() for _ in range(rng.randint(20, 200))]
        if n % 2:
            k, ws = rng.choice(items)
            copy = [w if rng.random() > 0.12 else word() for w in ws]
            at = rng.randrange(len(body))
            body[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in copy]
            want.add((100 + n, k))
        rows.append((100 + n, " ".join(body)))
    bench = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items] + [(90, None), (91, ""), (92, "two words")], "item_id long, text string")
    docs = spark.createDataFrame([(d, t, 0.5, 7) for d, t in rows], "doc_id long, text string, score double, item_id int")
    for s in (decontaminate.Settings(), decontaminate.Settings(block_words=100)):  # one block, and many
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs, bench, s).collect()} == want
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.contaminated_pairs(docs.limit(0), bench).count() == 0 == decontaminate.contaminated_pairs(docs, bench.limit(0)).count()


def test_query_agrees_with_alignment_of_all_pairs(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in queries.op6_decontamination(spark, SF).collect()}
    sets = {r.item_id: set(decontaminate.words_of(r.text)) for r in items}
    want = set()
    for d in docs:
        ws = decontaminate.words_of(d.text)
        have = set(ws)
        for r in items:
            iw = decontaminate.words_of(r.text)
            if len(sets[r.item_id] & have) * 4 >= len(sets[r.item_id]):  # fewer shared words cannot reach half
                code = {w: i for i, w in enumerate({*iw, *ws})}
                score, _ = decontaminate.smith_waterman(np.array([code[w] for w in iw]), np.array([code[w] for w in ws]))
                if score >= 0.5 * len(iw):
                    want.add((d.doc_id, r.item_id))
    assert got == want


def test_copies_with_every_few_words_edited(spark):
    """Copies whose unedited runs are as short as one word, beside verbatim ones, against alignment of all pairs."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = {i: [word() for _ in range(n)] for i, n in enumerate([40, 40, 31, 17, 12, 5, 3])}
    rows = []
    for i, ws in items.items():
        edits = [[w if (j + 1) % every else word() for j, w in enumerate(ws)] for every in (2, 3, 4, 5, 6)]
        edits += [[x for w in ws for x in (w, word())], [w for j, w in enumerate(ws) if j % 4], ws, ws[: len(ws) // 2] + ws[: len(ws) // 2], ws[::-1]]
        for copy in edits:
            rows.append((len(rows), [*(word() for _ in range(rng.randint(0, 60))), *copy, *(rng.choice(ws) for _ in range(5)), *(word() for _ in range(30))]))
    scores = {(d, i): table_score(ws, ts) for d, ts in rows for i, ws in items.items()}
    expected = {k: v for k, v in scores.items() if v >= 0.5 * len(items[k[1]])}
    assert len(expected) > 50
    bench = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items.items()], "item_id long, text string")
    docs = spark.createDataFrame([(d, " ".join(ts)) for d, ts in rows], "doc_id long, text string")
    for s in (decontaminate.Settings(), decontaminate.Settings(block_words=50)):
        assert {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated_pairs(docs, bench, s).collect()} == expected


def test_seeds_meet_every_pair_that_aligns():
    """Copies edited in all ways, most of them near the share, among words that many items have: what meets is all that aligns."""
    import numpy as np

    from lexmill.llm import decontaminate

    rng = np.random.default_rng(12)
    for share in (0.5, 0.75):
        s = decontaminate.Settings(share=share)
        items = [rng.integers(1, rng.choice([6, 40, 4000]), n) for n in rng.integers(3, 70, 120)]
        block = decontaminate.Block([(i, [b"%d" % w for w in ws]) for i, ws in enumerate(items)], s)
        found = missed = 0
        for trial in range(150):
            ws, out = items[trial % len(items)], []
            kind, keep = trial % 4, rng.uniform(share - 0.1, 0.99)
            for w in ws.tolist():  # words replaced, put between, left out, or all of these
                replaced, between = (kind == 0 and rng.random() > keep), (kind in (1, 3) and rng.random() > keep * 0.5)
                if not (kind in (2, 3) and rng.random() > keep):
                    out.append(int(rng.integers(5000, 9000)) if replaced else w)
                if between:
                    out.append(int(rng.integers(1, 40)))
            around = [rng.integers(1, 5000, rng.integers(0, 400)).tolist() for _ in range(2)]
            words = block.numbers(" ".join(map(str, around[0] + out + around[1])))
            told = {k for _, k, _, _ in block.candidates([words])}
            for k, item in enumerate(block.words):
                score, _ = decontaminate.smith_waterman(item, words)
                if score >= share * len(item):
                    found += 1
                    missed += k not in told
        assert found > 60 and not missed


def test_many_items_cost_a_document_little():
    import time

    import numpy as np

    from lexmill.llm import decontaminate

    rng = np.random.default_rng(13)
    weights = 1 / np.arange(1, 30_001)
    some = lambda n: " ".join(f"w{i}" for i in rng.choice(30_000, n, p=weights / weights.sum()))
    texts, took = [some(400) for _ in range(60)], []
    for n in (200, 20_000):
        block = decontaminate.Block([(i, decontaminate.words_of(some(50))) for i in range(n)], decontaminate.Settings())
        began = time.process_time()
        for text in texts:
            list(block.candidates([block.numbers(text)]))
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]  # a hundred times the items
