import random
import re

from pyspark.sql import functions as F

from strandweave.llm import pii, pii_rules

from .helpers import docs, prose

KEY = b"test key"
ROWS = [
    (1, "Mail john.smith7@mail.example.com or +1 (017) 555-7713, from 97.51.17.173."),
    (2, "JOHN.SMITH7@MAIL.EXAMPLE.COM again, phone +1 017 555 7713 and card 4539 1488 0343 6467"),
    (3, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" then Mrs. Anna Schmidt met John Smith; Mr Smith left. Госпожа: госпожа Ирина Петрова'),
    (4, "Licensed under CC BY-NC 4.0. On 2021-03-04 there were 1,000,000 of 3.5.2 things at 10:30: none."),
    (5, None), (6, ""), (7, "ssn 078-05-1120, acct DE89 3704 0044 0532 0130 00, password: hunter2hunter2 end"),
    (8, "192.168.1.7 and 300.1.1.1 and 9807915762804490!!"),
]


def run(spark, rows, key=KEY):
    return {r.doc_id: r for r in pii.pseudonymise(docs(spark, rows), key).collect()}


def test_kinds_format_and_coreference(spark):
    got = run(spark, ROWS)
    assert [got[i].n_entities for i, _ in ROWS] == [3, 3, 8, 0, 0, 0, 3, 2]
    assert got[4].text == ROWS[3][1] and got[5].text is None and got[6].text == ""
    for i, old in ROWS:
        if got[i].n_entities:
            kinds = [k for _, _, k, _ in pii_rules.find(old)]
            assert [k for _, _, k, _ in pii_rules.find(got[i].text)] == kinds
            assert not {v for _, _, _, v in pii_rules.find(got[i].text)} & {v for _, _, _, v in pii_rules.find(old)}
    one, two = (pii_rules.find(got[i].text) for i in (1, 2))
    assert one[0][3] == two[0][3] and one[1][3] == two[1][3]  # the same address and number in two shapes
    assert re.fullmatch(r"Mail \S+@\S+\.com or \+1 \(\d{3}\) \d{3}-\d{4}, from [\d.]+\.", got[1].text)
    assert re.search(r"[A-Z.\d]+@[A-Z.]+\.COM again", got[2].text) and re.search(r"card \d{4} \d{4} \d{4} \d{4}$", got[2].text)
    names = re.search(r"Mrs\. (\w+) (\w+) met (\w+) (\w+); Mr (\w+) left.*госпожа (\w+) (\w+)", got[3].text)
    assert names[4] == names[5] and names[2] != names[4] and names[7][0] in "БВГДЗКЛМНПРСТФЧ"
    assert names[1] in pii_rules.GIVEN["latin", "f"] and names[3] in pii_rules.GIVEN["latin", "m"] and names[6] in pii_rules.GIVEN["cyrillic", "f"]
    assert got[8].text.startswith("192.168.") and "300.1.1.1" in got[8].text


def test_keyed_and_repeatable(spark):
    assert run(spark, ROWS) == run(spark, list(reversed(ROWS)))
    assert run(spark, ROWS)[1].text != run(spark, ROWS, b"another")[1].text


def test_distinct_entities_stay_distinct_when_draws_collide(spark):
    names = sorted({x for script_gender, pool in pii_rules.GIVEN.items() for x in pool if script_gender == ("latin", "f")})
    entities = [("given:latin:f", n.lower()) for n in names] + [("given:latin:f", f"x{i}") for i in range(60)]
    got = pii.replacements(spark.createDataFrame(entities, "kind string, value string"), KEY).collect()
    assert len(got) == len(entities) == len({r.surrogate for r in got})
    assert not {r.surrogate for r in got} & {v for _, v in entities}


def test_many_rows(spark):
    rng = random.Random(4)
    stock = [f"user{i}@host{i % 3}.org" for i in range(40)] + [f"10.0.{i}.{j}" for i in range(5) for j in range(5)]
    rows = [(i % 90, " ".join([*prose(rng, 5), rng.choice(stock), "hot@example.org"])) for i in range(400)] + [(500 + i, " ".join(prose(rng, 9))) for i in range(50)]
    table = docs(spark, rows).withColumn("n_entities", F.lit("x")).withColumn("__uid", F.lit(7))
    got = pii.pseudonymise(table, KEY)
    assert set(got.columns) == set(table.columns)
    new = got.collect()
    assert len(new) == 450 and len({pii_rules.find(r.text)[-1][3] for r in new if r.n_entities}) == 1
    assert len({e[3] for r in new for e in pii_rules.find(r.text)}) == len({e[3] for _, t in rows for e in pii_rules.find(t)})
    assert {r.text for r in new if not r.n_entities} == {t for i, t in rows if i >= 500}
    assert pii.pseudonymise(docs(spark, []), KEY).count() == 0


def replaced(spark, entities):
    got = pii.replacements(spark.createDataFrame(entities, "kind string, value string"), KEY).collect()
    assert sorted((r.kind, r.value) for r in got) == sorted(entities)
    assert len({(r.kind, r.surrogate) for r in got}) == len(entities) and all(r.value != r.surrogate for r in got)
    return {(r.kind, r.value): r.surrogate for r in got}


def test_small_and_full_spaces_of_values(spark):
    mailboxes = [("email", f"{x}@example.com") for x in pii_rules.ALPHABETS["latin"]] + [("email", "_@a.org"), ("email", "_@b.org")]
    got = replaced(spark, mailboxes + [("secret", "--------"), ("secret", "........"), ("hex", "ab" * 20)])
    assert len({v.rpartition("@")[2] for (_, o), v in got.items() if o.endswith("@example.com")}) == 1
    # every address of a network occurs, so none is free: they exchange theirs
    network = [("ipv4", f"192.168.{i}.{j}") for i in range(256) for j in range(0, 256)]
    got = replaced(spark, network)
    assert all(v.startswith("192.168.") for v in got.values())


def test_one_entity_of_a_full_space_changes_places(spark):
    full = spark.createDataFrame([("ipv4", "192.168.1.1"), ("ipv4", "10.0.0.9")], "kind string, value string")
    settled = spark.createDataFrame([("ipv4", "192.168.1.2", "192.168.7.7"), ("ipv4", "10.0.0.1", "10.4.5.6"), ("ipv4", "10.0.0.2", "10.4.5.7"), ("email", "a@b.c", "x@y.c")], "kind string, value string, surrogate string")
    got = {r.value: r.surrogate for r in pii.exchanged(full, settled, KEY).collect()}
    assert got["192.168.1.1"] == "192.168.7.7" and got["192.168.1.2"] == "192.168.1.1" and got["a@b.c"] == "x@y.c"
    assert len(got) == 6 == len(set(got.values())) and all(v.split(".")[0] == o.split(".")[0] for o, v in got.items() if "@" not in o)


def test_check_digits_and_endings():
    assert pii_rules._mod97("DE89370400440532013000") == 1
    new = pii_rules.surrogate(KEY, "iban", "DE89370400440532013000", 0)
    assert pii_rules._mod97(new) == 1 and new[:2] == "DE" and new != "DE89370400440532013000"
    assert pii_rules.surrogate(KEY, "family:cyrillic", "петрова", 0).endswith("ова")


def test_long_text_with_many_entities(spark):
    text = " ".join(f"user{i}@host.org" for i in range(30_000))
    row = run(spark, [(1, text)])[1]
    assert row.n_entities == 30_000 and len(set(row.text.split(" "))) == 30_000 and "user1@host.org" not in row.text.split(" ")
