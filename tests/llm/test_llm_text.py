"""Text operators against brute force and on odd input: op2, op3, op8, op10."""

from __future__ import annotations

import random
import re
import textwrap

import pytest
from pyspark.sql import functions as F

from tidegate.llm import decontamination, license_scan, line_dedup, pii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def test_pseudonyms_keep_formats_and_link_values(spark):
    rows = [
        (1, "card 4111 1111 1111 1111, again 4111-1111-1111-1111; call +1 (212) 555-0147 or 212-555-0147"),
        (2, "4111111111111111 at 10.0.0.255, born 2000-02-29 / 29.02.2000 / 02/29/2000, id 123-45-6789"),
        (3, 'write A.b@Mail.example.org or a.B@mail.example.org; token = "0123456789abcdef" +49 30 1234567'),
        (4, "bad 4111111111111112, 2001-02-29, 300.1.1.1, 01.2.3.4, 666-12-3456, version 4.0. 112-555-0147"),
        (5, None),
        (6, ""),
        (None, "É 10.0.0.255é"),
        (7, "plain words, nothing else."),
        (8, 'TOKEN!! =!! "0123456789ABCDEF0123456789ABCDEF"!! +1%%% (212)*** 555-0147%%% and 11111111111111111111111111111111'),
    ]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id bigint, text string, n_card int")
    out = pii.pseudonymise(docs, "key")
    got = {r["doc_id"]: r for r in out.collect()}
    cards = re.findall(r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}", got[1]["text"])
    assert len(cards) == 2 and " " in cards[0] and "-" in cards[1]
    digits = {re.sub(r"\D", "", c) for c in cards}
    assert len(digits) == 1 and digits != {"4111111111111111"} and _luhn(next(iter(digits)))
    assert next(iter(digits)) in got[2]["text"]
    phones = re.findall(r"\(?([2-9]\d\d)\)?[ -]([2-9]\d\d)-(\d{4})", got[1]["text"])
    assert len(phones) == 2 and phones[0] == phones[1] != ("212", "555", "0147")
    assert "+1 (" in got[1]["text"]
    dates = re.search(r"(\d{4})-(\d\d)-(\d\d) / (\d\d)\.(\d\d)\.(\d{4}) / (\d\d)/(\d\d)/(\d{4})", got[2]["text"]).groups()
    assert dates[:3] == (dates[5], dates[4], dates[3]) == (dates[8], dates[6], dates[7])
    assert "123-45-6789" not in got[2]["text"] and re.search(r"id \d{3}-\d\d-\d{4}$", got[2]["text"])
    mails = re.findall(r"u[0-9a-f]{12}@example\.invalid", got[3]["text"])
    assert len(mails) == 2 and mails[0] == mails[1]
    assert re.search(r'token = "[0-9a-f]{16}" \+49 \d\d \d{7}$', got[3]["text"])
    assert "0123456789abcdef" not in got[3]["text"]
    assert got[4]["text"] == rows[3][1] and got[5]["text"] is None and got[6]["text"] == ""
    assert got[7]["text"] == rows[7][1]
    assert re.search(r'"[0-9a-f]{32}"!! \+1%%% \([2-9]\d\d\)\*\*\* [2-9]\d\d-\d{4}%%% and 1{32}$', got[8]["text"])
    assert "0123456789ABCDEF" not in got[8]["text"] and "555-0147" not in got[8]["text"]
    assert (got[8]["n_secret"], got[8]["n_phone"]) == (1, 1)
    counts = {i: [got[i][f"n_{k}"] for k in pii.KINDS] for i in got}
    assert counts[1] == [0, 0, 2, 0, 2, 0, 0] and counts[2] == [0, 0, 1, 1, 0, 1, 3]
    assert counts[3] == [2, 1, 0, 0, 1, 0, 0] and not any(counts[4] + counts[5] + counts[6] + counts[7])
    again = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "key").collect()}
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "other").collect()}
    assert again == {i: r["text"] for i, r in got.items()} and other[1] != again[1]
    assert pii.pseudonymise(docs.limit(0), "key").count() == 0


def _iban_rest(plain):
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_pseudonyms_of_account_numbers_stay_valid_and_linked(spark):
    def made(country, account):
        return f"{country}{98 - _iban_rest(country + '00' + account):02d}{account}"

    plain = ["GB82WEST12345698765432", "DE89370400440532013000", *(made("DE", f"{7 * k:018d}") for k in range(300))]
    assert all(_iban_rest(p) == 1 for p in plain)
    spaced = " ".join(plain[1][i : i + 4] for i in range(0, 22, 4))
    texts = [*(f"pay {p}, soon" for p in plain), f"pay {spaced}, soon", "pay DE88370400440532013000, soon", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, "key").collect()}
    new = [got[i]["text"][4:-6] for i in range(len(plain))]
    assert all(_iban_rest(n) == 1 and n[:2] == p[:2] and len(n) == len(p) for n, p in zip(new, plain))
    assert len(set(new)) == len(plain) and new[0][4:8] == "WEST" and new[0] != plain[0]
    n = len(plain)
    assert got[n]["text"][4:-6].replace(" ", "") == new[1] and got[n]["text"].count(" ") == texts[n].count(" ")
    assert got[n + 1]["text"] == texts[n + 1] and got[n + 2]["text"] is None
    assert [got[i]["n_iban"] for i in (0, n, n + 1, n + 2)] == [1, 1, 0, 0]


def test_feistel_is_a_permutation(spark):
    grid = spark.range(60).select((F.col("id") % 6).alias("l"), F.floor(F.col("id") / 6).alias("r"))
    state = pii._feistel("k", "t", F.col("l"), F.col("r"), F.lit(6), F.lit(10))
    out = grid.select("l", "r", state.alias("s")).collect()
    images = {(r["s"]["left"], r["s"]["right"]) for r in out}
    assert images == {(a, b) for a in range(6) for b in range(10)}
    assert sum((r["l"], r["r"]) != tuple(r["s"]) for r in out) > 40


def test_pseudonyms_of_dates_are_distinct(spark):
    days = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"),
    )
    texts = [r["text"] for r in pii.pseudonymise(days, "k").collect()]
    assert len(set(texts)) == 3000 and all(re.fullmatch(r"\d{4}-\d\d-\d\d", t) for t in texts)


def _scan(docs, items, n=10):
    windows = {}
    for item, text in items:
        words = _words(text)
        size = min(len(words), n)
        if words and item is not None:
            for i in range(len(words) - size + 1):
                windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = _words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if items_of := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= items_of
        out.append((doc, len(words), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [50_000, 0])
def test_decontamination_matches_brute_force(spark, limit):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(30)] + ["É", "é", "日本"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([30, 12, 10, 9, 2, 1, 14])]
    items += [(7, None), (8, ""), (9, " .,"), (10, items[0][1]), (10, items[1][1]), (100, items[3][1].upper())]
    docs = []
    for i in range(40):
        words = rng.choices(vocabulary, k=rng.choice([0, 3, 50]))
        if i % 3 == 0:
            source = rng.choice(items[:7])[1].split()
            start = rng.randrange(len(source))
            words[10:10] = source[start : start + 11]
        docs.append((i, ",\n".join(words).title()))
    docs += [(50, None), (51, ""), (None, items[0][1]), (0, docs[0][1])]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, words string, n_hit int")
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id bigint, text string, size int")
    got = decontamination.scan(df, bench, set_windows=limit).collect()
    want = _scan(docs, items)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(row[5] for row in want) and not all(row[5] for row in want)
    clean = decontamination.remove_documents(df, bench, set_windows=limit)
    assert clean.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect() if r["doc_id"] is not None) == sorted(
        (d, t) for d, t in docs if d is not None and not _scan([(d, t)], items)[0][5]
    )
    none = bench.limit(0)
    assert not any(r["contaminated"] for r in decontamination.scan(df, none, set_windows=limit).collect())
    assert decontamination.remove_documents(df, none).count() == len(docs)
    assert decontamination.scan(df.limit(0), bench, set_windows=limit).count() == 0


def test_decontamination_never_broadcasts_many_items_of_one_wording(spark):
    prompt = " ".join(f"p{i}" for i in range(12))
    items = [(i, f"{prompt} q{i}") for i in range(60)]
    docs = [(1, f"a {prompt} b"), (2, f"{prompt} q7"), (3, "nothing"), (4, prompt)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # 63 windows, 240 rows of windows and items; the windows stand in the plan twice. Beyond
        # the limit only the 4 windows that occur count; the rows of their items are 181.
        for limit, hints in ((240, 3), (239, 2), (63, 2), (62, 2), (4, 2), (3, 0)):
            found = decontamination.scan(df, bench, set_windows=limit)
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("strategy=broadcast") == hints
            assert sorted((tuple(r) for r in found.collect()), key=repr) == _scan(docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_license_scan_matches_brute_force(spark):
    rng = random.Random(6)
    tokens = sorted({t for _, text in license_scan.TEMPLATES for t in license_scan.template_tokens(text)})
    texts = [
        "cc by nc cc by nc; under the MIT\nlicense", "Apache License, Version 2.0", "cc-by-nc", None, "", "\n\n",
        "ALL rights reserved", "This work is licensed under the GNU public license version three",
        "under the mit licenses", "İ under the mit license é",
    ]
    for _ in range(60):
        label, text = rng.choice(license_scan.TEMPLATES)
        words = [w for w in text.split() if rng.random() < 0.9] + rng.choices(tokens, k=rng.randrange(4))
        rng.shuffle(words)
        texts.append("\n".join([" ".join(words), " ".join(rng.choices(tokens, k=12))]))
    docs = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id bigint, text string, labels string, line string"
    )
    got = sorted(tuple(r) for r in license_scan.scan(docs).collect())
    want = []
    for i, text in enumerate(texts):
        words, places, base, labels, best = _words(text), [], set(), set(), 0.0
        for phrase, label in license_scan.PHRASES:
            sought = phrase.split()
            for at in range(len(words)):
                if words[at : at + len(sought)] == sought:
                    places.append(at)
                    base.add(label)
        for line in (text or "").split("\n"):
            for label, template in license_scan.TEMPLATES:
                wanted = set(license_scan.template_tokens(template))
                share = len(wanted & set(_words(line))) / len(wanted)
                if 100 * len(wanted & set(_words(line))) >= 85 * len(wanted):
                    labels.add(label)
                    best = max(best, share)
        want.append((
            i, len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if places else best,
        ))
    assert got == want
    assert sum(r[7] > 0 for r in want) > 10
    assert license_scan.scan(docs.limit(0)).count() == 0


def _dedup(docs, least):
    """All runs of lines with ``least`` words, by brute force."""
    rows = []
    for doc, text in docs:
        lines = (text or "").split("\n") if text is not None else []
        rows.append((doc, text, lines, [i for i, l in enumerate(lines) if l.split()]))
    runs = []
    for d, (doc, _, lines, solid) in enumerate(rows):
        for x in range(len(solid)):
            for y in range(x, len(solid)):
                part = solid[x : y + 1]
                if sum(len(lines[i].split()) for i in part) >= least:
                    runs.append((tuple(lines[i].strip(" \t\r") for i in part), d, part[0], part[-1]))
    origin = {}
    for content, d, first, last in sorted(runs, key=lambda r: (rows[r[1]][0], r[2], r[3])):
        origin.setdefault(content, (d, first, last))
    dead = set()
    for content, d, first, last in runs:
        o = origin[content]
        if d != o[0] or first > o[2]:
            dead |= {(d, i) for i in range(first, last + 1)}
    return sorted(
        (doc, None if text is None else "\n".join(l for i, l in enumerate(lines) if (d, i) not in dead),
         len(solid), sum((d, i) in dead for i in solid))
        for d, (doc, text, lines, solid) in enumerate(rows)
    )


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(8)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 2, 5, 9]))) for _ in range(14)]
    docs = []
    for i in range(40):
        picked = [rng.choice([*lines, f"own line {i} {rng.random()}", "", "  "]) for _ in range(rng.choice([1, 6, 12]))]
        if i % 4 == 0:
            at = rng.randrange(len(lines) - 4)
            picked[1:1] = [f" {x}\t" for x in lines[at : at + 4]]
        docs.append((i, "\n".join(picked)))
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, "a b c\n" * 30), (64, docs[0][1])]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, line int, n_lines string")
    out = line_dedup.dedup(df, least=10)
    assert out.columns == ["doc_id", "text", "line", "n_lines", "n_deleted"]
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_deleted"]) for r in out.collect())
    assert got == _dedup(docs, 10)
    assert sum(r[3] > 0 for r in got) > 5


def test_line_dedup_of_repeated_rows_null_ids_and_nothing(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(5, passage), (5, passage), (None, passage), (2, f"intro\n{passage}\nend"), (9, f"{passage}\nmore")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["text"], r["n_deleted"]) for r in line_dedup.dedup(df).collect()), key=repr)
    assert got == sorted(
        [(5, "", 1), (5, "", 1), (None, "", 1), (2, rows[3][1], 0), (9, "more", 1)], key=repr
    )
    assert line_dedup.dedup(df.limit(0)).count() == 0


def _windows(text, span, rule):
    """Labels and best share by brute force: ``rule`` gives need and check of a template."""
    words, labels, best = _words(text), set(), 0.0
    for label, template in license_scan.TEMPLATES:
        wanted, size = set(_words(template)), span * len(_words(template))
        for at in range(len(words)):
            have = len(wanted & set(words[at : at + size]))
            if words[at] in wanted and rule(label, wanted, have, words[max(at - 1, 0) : at + size + 16]):
                labels.add(label)
                best = max(best, have / len(wanted))
    return labels, best


def _scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in license_scan.windows(docs).collect()}


def _wrapped(text, width, prefix=""):
    return "\n".join(prefix + line for line in textwrap.wrap(text, width, break_long_words=False))


def test_license_windows_find_wrapped_notices(spark):
    notices = [n for n in license_scan.TEMPLATES if len(n[1].split()) > 15]
    assert {label for label, _ in notices} == {"mit", "gpl-3", "bsd"}
    texts, labels = [], []
    for label, text in notices:
        for width, prefix in ((78, ""), (40, " * "), (30, "# "), (10_000, "")):
            texts.append("Copyright (c) 2020\n\n" + _wrapped(text, width, prefix) + "\n\nmore text")
            labels.append(label)
    got = _scanned(spark, texts)
    assert [got[i]["labels"] for i in range(len(texts))] == labels
    assert all(got[i]["score"] == 1.0 for i in got)


def test_license_windows_are_bounded(spark):
    apart = " ".join(["all", *["x"] * 40, "rights", *["y"] * 40, "reserved"])
    got = _scanned(spark, [apart, "w " * 500 + "all rights\nreserved" + " w" * 500, None, ""])
    assert [got[i]["labels"] for i in range(4)] == ["", "reserved", "", ""]
    assert [got[i]["score"] for i in range(4)] == [0.0, 1.0, 0.0, 0.0]
    assert license_scan.windows(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def _places(words, *sought):
    return [i for i in range(len(words)) if words[i : i + len(sought)] == list(sought)]


def _notice_rule(label, wanted, have, around):
    """Short templates whole, others to 85 %; what tells a license from its relatives, word by word."""
    if have < len(wanted) and (len(wanted) <= 12 or 100 * have < 85 * len(wanted)):
        return False
    if label == "mit":
        return bool(_places(around, "mit", "license") or _places(around, "restriction"))
    if label == "bsd":
        return "redistribution" in around
    if label == "reserved":
        return any(i > 0 and around[i - 1] != "some" or i == 0 for i in _places(around, "rights"))
    if label == "cc-by-nc":
        rest = [around[i + 3 : i + 6] for i in _places(around, "cc", "by", "nc")]
        return any(r[:2] == ["4", "0"] or r[1:] == ["4", "0"] and r[0] not in ("sa", "nd") for r in rest)
    if label == "apache-2":
        for i in _places(around, "apache", "license"):
            rest = around[i + 2 : i + 9]
            after = rest[3:] if rest[2:3] in (["0"], ["1"]) and rest[3:4] == ["or"] else rest[2:]
            both = after[:2] == ["or", "2"] or after[:3] == ["or", "version", "2"]
            if rest[:2] != ["version", "1"] or both:
                return True
        return False
    named = [
        (i, j) for i in range(len(around)) for j in (0, 1)
        if around[i] == "gnu" and around[i + 1 + j : i + 4 + j] == ["general", "public", "license"]
    ]
    if not named or min(named)[1]:
        return False
    rest = around[min(named)[0] + 4 :]
    for k, word in enumerate(rest[:11]):
        if word == "version" or re.match("v[0-9]", word):
            old = rest[k : k + 2] in (["version", "1"], ["version", "2"]) or word in ("v1", "v2")
            rest = rest[k + (2 if word == "version" else 1) :]
            return not old or rest[:2] == ["or", "3"] or rest[:3] == ["or", "version", "3"]
    return True


def test_license_windows_tell_relatives_apart(spark):
    gpl = next(t for label, t in license_scan.TEMPLATES if label == "gpl-3" and t.startswith("This program"))
    later = "of the License, or (at your option) any later version."
    # The rest of the usual header names the license again, without a version.
    rest = "This program is distributed in the hope that it will be useful. See the GNU General Public License."
    cases = [
        ("Licensed under CC BY 4.0", ""),
        ("Licensed under CC BY-SA 4.0", ""),
        ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
        ("Licensed under the Apache License, Version 1.0", ""),
        ("Licensed under the Apache License, Version 1.1. See section 2.", ""),
        ("Licensed under version 2.0 of the Apache License", "apache-2"),
        ("This work is licensed under the GNU General Public License, version 2.", ""),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ""),
        ("This work is licensed under the GNU Affero General Public License, version 3.", ""),
        ("This work is licensed under the GNU General Public License, version 2 or version 3.", "gpl-3"),
        ("This work is licensed under version 3 of the GNU\nGeneral Public License.", "gpl-3"),
        (f"{gpl}, either version 2 {later} {rest}", ""),
        (f"{gpl}, either version 3 {later} {rest}", "gpl-3"),
        (f"{gpl}, either version 3 {later}\n\n{gpl}, either version 2 {later}", "gpl-3"),
        (f"{gpl}, either version 2 {later}\n\n{gpl}, either version 3 {later}", "gpl-3"),
        (gpl.replace("General", "Lesser General"), ""),
        (gpl.replace("General", "Library General"), ""),
        (f"{'x' * 100_000} {gpl}", "gpl-3"),
        ("Some rights reserved, not all", ""),
        ("All other rights\nare reserved", "reserved"),
        # Terms of another license that hold 85 % of the words of the MIT grant.
        ("permission is hereby granted to any person obtaining a copy of this software, associated documentation "
         "and/or data, free of charge and under any and all copyright rights in the software, to deal in both", ""),
    ]
    texts = [_wrapped(text, 40) for text, _ in cases]
    got = _scanned(spark, texts)
    assert [got[i]["labels"] for i in range(len(cases))] == [label for _, label in cases]
    for i, text in enumerate(texts):
        base = set(got[i]["base_labels"].split(",")) - {""}
        assert got[i]["labels"] == ",".join(sorted(base | _windows(text, license_scan.SPAN, _notice_rule)[0]))


def test_license_windows_match_brute_force(spark):
    rng = random.Random(28)
    tokens = sorted({t for _, text in license_scan.TEMPLATES for t in license_scan.template_tokens(text)})
    texts = []
    for _ in range(80):
        label, text = rng.choice(license_scan.TEMPLATES)
        words = [w for w in text.split() if rng.random() < 0.97]
        for at in sorted(rng.sample(range(len(words)), min(3, len(words))), reverse=True):
            words[at:at] = rng.choices(["and", "filler", "version 2", "some", *tokens], k=rng.choice([0, 1, 12, 40]))
        texts.append(_wrapped(" ".join([*rng.choices(tokens, k=9), *words, *rng.choices(tokens, k=9)]), 40))
    got = _scanned(spark, texts)
    hits = 0
    for i, text in enumerate(texts):
        labels, best = _windows(text, license_scan.SPAN, _notice_rule)
        row = got[i]
        base = set(row["base_labels"].split(",")) - {""}
        assert row["labels"] == ",".join(sorted(base | labels)), text
        assert row["score"] == (1.0 if row["n_base"] else best)
        hits += bool(labels)
    assert 10 < hits
