import re

from gearwatch.llm import license_join as J
from tests.llm.helpers import corpus, odd_rows, prose, table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_blocks(ws):
    """Every block is compared with every template; overlapping ones are joined."""
    found = []
    for label, notices in J.TEMPLATES.items():
        for notice in notices:
            ts, rows = plain_words(notice), []
            others = [set(plain_words(t)) for other, rest in J.TEMPLATES.items() if other != label for t in rest]
            must = {w for o in others if len(o & set(ts)) >= 0.8 * len(set(ts)) for w in set(ts) - o}
            width = min(len(ts) + len(ts) // 2, len(ws))
            for i in range(len(ws) - width + 1):
                held = set(ws[i:i + width]) & set(ts)
                if held and len(held) / len(set(ts)) >= 0.8 - 1e-12 and must <= held:
                    share = len(held) / len(set(ts))
                    if rows and i <= rows[-1][2]:
                        rows[-1] = (label, rows[-1][1], i + width, max(share, rows[-1][3]))
                    else:
                        rows.append((label, i, i + width, share))
            found += rows
    return found


def plain(text):
    ws = plain_words(text)
    places = [(i, label) for phrase, label in J.PHRASES.items() for i in range(len(ws)) if ws[i:i + len(phrase.split())] == phrase.split()]
    base, found = {label for _, label in places}, plain_blocks(ws)
    labels, score = {label for label, *_ in found}, max((share for *_, share in found), default=0.0)
    starts = [i for i, _ in places]
    return (len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)


def texts():
    noise = [" ".join(prose(40, k)) for k in range(4)]
    notices = [t for texts in J.TEMPLATES.values() for t in texts]
    found = [f"{noise[k % 4]}\n{t}. {noise[(k + 1) % 4]}" for k, t in enumerate(notices)] + ["\n".join(notices), "\n".join(notices[1:4] + notices[:2])]
    mit = J.TEMPLATES["mit"][1].split()
    found += [" ".join(mit[:n]) for n in range(8, len(mit))] + [" filler ".join(mit[i:]) for i in range(0, 12, 3)]
    found += ["Released under the MIT License.", "the mit\nLICENSE, or GNU General Public license; mit license", "general public", "mit licensed", "MIT-License Apache_License apache license",
              "Licensed under CC BY-NC 4.0.", "licensed under the Apache License, Version 2.0.", "mitİ license É0", "license"]
    return found


def test_scan_equals_plain_search(spark):
    rows = odd_rows(corpus(11) + texts())
    found = J.scan(table(spark, rows).selectExpr("*", "'x' AS labels", "3 AS n_words")).collect()
    assert sorted([tuple(r) for r in found], key=repr) == sorted([(i, *plain(t)) for i, t in rows], key=repr)
    assert {label for r in found for label in r.labels.split(",")} >= set(J.TEMPLATES)


def test_filters_lose_no_block():
    """Whatever the word order, the blocks are those of comparing every block."""
    for skew in range(5):
        frequency = {w: (hash((skew, w)) % 7) for w in J.template_words(J.TEMPLATES)}
        known = J.templates_of(J.TEMPLATES, frequency, J.THRESHOLD)
        for candidate in texts():
            ws = J.words_of(candidate)
            found = [(t.label, *block) for t in known for block in t.blocks(ws, [i for i, w in enumerate(ws) if w in t.prefix])]
            assert found == plain_blocks(plain_words(candidate))


def test_near_templates_are_told_apart(spark):
    wanted = {"Licensed under CC BY 4.0": "", "Licensed under CC BY-NC 4.0": "cc-by-nc", "Licensed under CC BY-SA 4.0": "cc-by-sa", "under CC BY-SA 4.0 licensed or CC BY-NC 4.0": "cc-by-nc,cc-by-sa"}
    assert [r.labels for r in J.scan(table(spark, list(wanted))).orderBy("doc_id").collect()] == list(wanted.values())


def test_blocks_of_a_notice_without_its_first_sentence(spark):
    noise = " ".join(prose(60, 5))
    rows = [(1, f"{noise} {J.TEMPLATES['bsd'][2]} {noise}"), (2, "\n".join(J.TEMPLATES["gpl"][1:])), (3, None), (4, noise), (None, J.TEMPLATES["mpl"][1]), (1, J.TEMPLATES["mit"][2])]
    found = sorted(map(tuple, J.blocks(table(spark, rows)).collect()), key=repr)
    assert found == sorted([(i, *block) for i, t in rows for block in plain_blocks(plain_words(t))], key=repr)
    assert {(r[0], r[1]) for r in found} == {(1, "bsd"), (1, "mit"), (2, "gpl"), (None, "mpl")}
    assert J.blocks(table(spark, ["x"]).limit(0)).count() == 0


def test_whole_small_table_and_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert sorted(map(tuple, J.scan(docs).collect())) == sorted((r.doc_id, *plain(r.text)) for r in docs.collect())
    assert J.scan(docs.limit(0)).count() == 0


def test_parts_without_template_words(spark):
    rows = [(i, None if i % 2 else "") for i in range(20)] + [(2**62 + 1, "plain words"), (None, "MIT License"), (2**62 + 3, None)]
    found = J.scan(table(spark, rows).repartition(60)).collect()
    assert sorted([tuple(r) for r in found], key=repr) == sorted([(i, *plain(t)) for i, t in rows], key=repr)
    assert {r.n_words for r in J.scan(table(spark, [None, ""])).collect()} == {0}
