"""The llm operators on small fixtures: brute force, round trips, odd rows."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaglio.llm import boilerplate, consensus, leakage, linkage, names, packing, queries, toxicity

T = dt.datetime(2026, 5, 1)
GRANTS = "grant_id bigint, source_id string, title string, issuer string, description string, requirements array<string>, funding_text string, funding_min double, funding_max double, deadline date, found_at timestamp_ntz, last_seen_at timestamp_ntz, duplicate_of bigint, component bigint"


def grants(spark, rows):
    base = {"grant_id": None, "source_id": "s", "title": "Bando per la lana", "issuer": "Comune di Tale", "found_at": T, "last_seen_at": T, "component": 7}
    keys = [c.split()[0] for c in GRANTS.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}.get(k) for k in keys) for r in rows], GRANTS)


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame([("s", 5, "x"), ("t", 1, "x")], "id string, trust int, grant_id string")


WHOLE = "Il bando riguarda la lana. Si paga il 50% dei costi. La domanda va inviata entro maggio."


def test_survivors_field_by_field(spark, sources):
    rows = [
        {"grant_id": 1, "description": "Il bando riguarda la lana. Si paga…", "requirements": ["a", "b"], "deadline": dt.date(2099, 12, 31)},
        {"grant_id": 2, "description": WHOLE, "requirements": ["a", "b", "c"], "deadline": dt.date(2026, 7, 1), "duplicate_of": 1},
        {"grant_id": 3, "source_id": "t", "description": "  " + WHOLE.replace(" ", "  "), "requirements": ["Vedi bando"], "deadline": dt.date(2026, 6, 1), "duplicate_of": 2},
        {"grant_id": 4, "description": None, "requirements": None, "duplicate_of": 2},
        {"grant_id": 10, "description": WHOLE}, {"grant_id": 11, "duplicate_of": 999},
        {"grant_id": 20, "description": "", "requirements": []}, {"grant_id": 21, "description": None, "duplicate_of": 20},
    ]
    got = {(r.group_id, r.field): r.grant_id for r in consensus.survivors(grants(spark, rows), sources).collect()}
    assert got == {(1, "description"): 2, (1, "requirements"): 2, (1, "deadline"): 2}
    assert consensus.survivors(grants(spark, []), sources).count() == 0


def test_a_hot_group_is_aligned_in_blocks(spark, sources):
    rows = [{"grant_id": 1, "description": WHOLE}]
    rows += [{"grant_id": k, "description": WHOLE.replace("50%", f"{k}%") if k % 3 else WHOLE, "duplicate_of": k // 2} for k in range(2, 400)]
    got = {r.field: r.grant_id for r in consensus.survivors(grants(spark, rows), sources).collect()}
    assert got == {"description": 1}


def page_rows(n):
    nav, foot = ["Home", "Contatti", "Servizi", "Albo"], ["Ente gestore", "Via Lunga 3", "P. IVA 123", "Credits"]
    rows = []
    for i in range(n):
        body = [f"Bando numero {i} per la lana", f"Testo unico {i * 7}.", "Scadenza" if i % 6 == 0 else f"Prima di {i}.", f"Altra frase {i * 11}."]
        lines = nav + [f"Home > Avvisi > Bando numero {i} per"] + body + ["Avvisi correlati", f"Bando altro {i + 100}", "3 maggio 2026"] + foot
        rows.append((i, "s", f"https://h.ex/p/{i}", T, "\n".join(lines), "clash"))
    return rows


def test_template_lines_are_furniture(spark):
    schema = "page_id bigint, source_id string, url string, fetched_at timestamp_ntz, text string, host string"
    rows = page_rows(12) + [(50, "s", None, None, "", "c"), (51, None, None, T, None, "c"), (0, "s", "https://h.ex/p/0", T, page_rows(1)[0][4], "c")]
    frame = spark.createDataFrame(rows, schema)
    got = {}
    for r in boilerplate.furniture_lines(frame).collect():
        got.setdefault(r.page_id, []).append(r.line_no)
    assert sorted(got) == list(range(12))
    assert all(sorted(v) == [0, 1, 2, 3, 4, *range(9, 16)] for v in got.values())
    text = {r.page_id: r.main for r in boilerplate.main_text(frame.where("page_id = 3")).collect()}
    assert "Testo unico 21." in text[3]
    assert boilerplate.furniture_lines(frame.limit(0)).count() == 0


def test_refetched_pages_make_no_template(spark):
    schema = "page_id bigint, source_id string, url string, fetched_at timestamp_ntz, text string"
    rows = [(i, "s", "https://h.ex/one", T, "Bando unico\nprima riga\nseconda riga\nterza riga") for i in range(9)]
    assert boilerplate.furniture_lines(spark.createDataFrame(rows, schema)).count() == 0


def test_linkage_pairs_editions_and_lines(spark):
    themes = ["la zootecnia estensiva", "il restauro dei beni storici", "la pesca costiera", "il welfare aziendale"]
    who = ["delle cooperative", "dei giovani", "delle imprese artigiane"]
    g, r, true = [], [], set()
    for i, (t, w, year) in enumerate(itertools.product(themes, who, (2024, 2025))):
        due = dt.date(year, 7, 1 + i % 20)
        g.append({"grant_id": i, "title": f"Bando per {t} {w} {year}", "issuer": f"Comune di Luogo{'abcdefghilmn'[i // 2] * 3}", "deadline": due, "funding_text": f"fino a {10 + i}.000 euro", "found_at": dt.datetime(year, 5, 1)})
        r.append((1000 + i, f"AVVISO {t} {w.upper()} - edizione {year}", f"Com. Luogo{'abcdefghilmn'[i // 2] * 3}", due if i % 3 else None, (10 + i) * 1000.0, dt.date(year, 5, 3), None, "clash"))
        true.add((i, 1000 + i))
    g += [{"grant_id": 90, "title": None, "issuer": None}, g[0]]
    r.append((2000, None, None, None, None, None, None, "clash"))
    register = spark.createDataFrame(r, "reg_id bigint, title string, issuer string, deadline date, funding_max double, published_on date, territory string, grant_id string")
    rates = spark.createDataFrame([("EUR", 1.0)], "currency string, eur_rate double")
    linked = linkage.link(grants(spark, g), register, rates)
    got = {(x.grant_id, x.reg_id) for x in linkage.pairs_found(linked).collect()}
    assert got == true
    assert linked.where("confidence < 0 or confidence > 1").count() == 0
    assert linkage.link(grants(spark, []), register, rates).count() == 0


SPELLINGS = [
    ["Comune di Difetufi", "Città di Difetufi", "Com. Difetufi", "Amm.ne comunale di Difetufi", "COMUNE DI DIFETTUFI", "Difetufi (Comune)"],
    ["Provincia di Difetufi", "Amministrazioe Provinciael di Difetufi", "Prov. Difetufi"],
    ["Fondazione Luigi Bugoguzo", "Fond. Gigi Buggouzo", "Bugoguzo Luigi, Fond.", "Fond. L. Bugoguzo", "F.ne Luigi Bugoguzo ETS"],
    ["Fondazione Maria Bugoguzo"],
    ["Ente Nazionale Cammini e Sentieri", "Ente Naz. Sentieri & Cammini", "ENCS"],
    ["Università degli Studi di Novabba", "Ateneo di Novabba", "UniNovabba", "Univ. Novabba"],
    ["C.C.I.A.A. di Labomato", "Camera di Commercio Labomato"],
]


def test_spellings_of_one_body_are_linked(spark):
    rows, want, k = [], set(), 0
    for group in SPELLINGS:
        ids = list(range(k, k + len(group)))
        rows += list(zip(ids, group))
        want |= set(itertools.combinations(ids, 2))
        k += len(group)
    rows += [(900, None), (901, "  "), rows[0]]
    frame = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "spelling_id bigint, issuer string, kind string, form int")
    assert {(r.spelling_id_a, r.spelling_id_b) for r in names.same_entity_pairs(frame).collect()} == want
    assert names.same_entity_pairs(frame.limit(0)).count() == 0


def test_bands_follow_the_collision_curve():
    assert 1 - (1 - names.SIMILAR**names.ROWS) ** names.BANDS >= names.RECALL
    assert 1 - (1 - names.SIMILAR**names.ROWS) ** (names.BANDS - 1) < names.RECALL


def best_sum(lengths, room):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= room}
    return max(sums)


def test_fullest_is_the_optimum():
    random.seed(2)
    for _ in range(60):
        lengths = [random.randint(1, 20) for _ in range(random.randint(0, 9))]
        counts = {x: lengths.count(x) for x in lengths}
        room = random.randint(0, 60)
        got = packing.fullest(counts, room)
        assert sum(k * n for k, n in got.items()) == best_sum(lengths, room)
        assert all(n <= counts[k] for k, n in got.items())


def test_containers_hold_every_item_once(spark):
    random.seed(3)
    words = "bando lana pesca domanda costi euro legno".split()
    rows = [(i, " ".join(random.choices(words, k=random.choice([2, 3, 5, 9, 12, 20, 300])))) for i in range(300)] + [(500, None), (501, "")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id bigint, text string, tokens string")
    packed = packing.pack(docs, capacity=128).collect()
    counted = {r.doc_id: r.tokens for r in packing.token_counts(docs).collect()}
    per, room = {}, {}
    for r in packed:
        per.setdefault(r.doc_id, []).append((r.part, r.tokens))
        room[r.container_id] = room.get(r.container_id, 0) + r.tokens
    assert {d: sum(t for _, t in v) for d, v in per.items()} == counted
    assert all(len(v) == -(-counted[d] // 128) and len({p for p, _ in v}) == len(v) for d, v in per.items())
    assert max(room.values()) <= 128 and len(room) <= 1.02 * -(-sum(counted.values()) // 128) + 1
    assert packing.pack(docs.limit(0), capacity=128).count() == 0


ITEM = "Scegli la risposta. Quesito 3. Con 65 voti contro 67, una cooperativa di apicoltori di Poffebive rinvia la seduta istruttoria; tuttavia a Nezesadi la cauzione viene svincolata a metà."


def brute(doc, item):
    """Longest run of the item's words, spelled alike, in the document's words."""
    a, b = leakage._WORD.findall(leakage.fold(doc)), leakage._WORD.findall(leakage.fold(item))
    best = 0
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            best = max(best, k)
    return best


def test_leaks_equal_brute_force(spark):
    random.seed(5)
    words = ITEM.split()
    docs = []
    for i in range(60):
        a = random.randrange(len(words) - 2)
        cut = words[a : a + random.randint(4, 18)]
        docs.append((i, "Testo prima, " + " ".join(cut) + " e altro dopo."))
    docs += [(100, None), (101, ""), (102, "x" * 60_000 + " " + ITEM)]
    frame = spark.createDataFrame([(i, t, 9) for i, t in docs], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(7, ITEM), (8, "troppo corto"), (9, None)], "item_id bigint, text string")
    leaked = leakage.leaks(frame, items)
    got = {r.doc_id: r.words for r in leaked.where("words >= 10").collect()}
    assert {r.doc_id for r in leakage.exact(leaked).collect()} == set(got) and got == {i: brute(t, ITEM) for i, t in docs if t and brute(t, ITEM) >= 10}
    assert leakage.leaks(frame, items.limit(0)).count() == 0


@pytest.mark.parametrize("change", [str.upper, lambda t: t.replace("o", "o­"), lambda t: t.replace(" ", "  \n"), lambda t: t.replace(" ", "​ "), lambda t: "".join(c + " " for c in t if c.isalnum()), lambda t: t.replace("seduta", "<b>sed</b>uta"), lambda t: t.replace("a", "à"), lambda t: t.replace(" ", "&nbsp;"), lambda t: t.replace(",", " -- ")])
def test_leaks_through_disguises(change):
    index = leakage.Items.build([(1, ITEM)])
    assert index.search(["altro", "Prima. " + change(" ".join(ITEM.split()[4:20])) + " Dopo."])[1][1][0] >= 10


def test_passages_with_edits_are_aligned():
    index = leakage.Items.build([(1, ITEM)])
    words = ITEM.split()
    for cut, edit in ((12, lambda w: w[:1] + "x" + w[1:]), (14, lambda w: w[1:]), (16, lambda w: "q" + w[1:])):
        passage = [edit(w) if i == cut // 2 else w for i, w in enumerate(words[4 : 4 + cut])]
        found = index.search(["Prima di tutto. " + " ".join(passage) + " Dopo altro."])[0].get(1)
        assert found is not None and found[0] < 10 <= found[1] and found[2] == 1
    far = [w[::-1] if i % 3 == 0 else w for i, w in enumerate(words[4:20])]
    assert index.search([" ".join(far)]) == [{}]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ9 _-’èßøœı²ſﬁжß<>&;()]b\u200b\u0301\n", max_size=40))
def test_fast_reduction_equals_the_words(text):
    fast = leakage.reduced(text)
    assert fast is None or fast.decode() == leakage.letters(text)[0]


def test_texts_in_other_scripts_are_searched():
    item = "один два три четыре пять шесть семь восемь девять десять одиннадцать двенадцать"
    index = leakage.Items.build([(1, item), (2, ITEM)])
    assert index.search(["Вот: " + item.upper() + "!"])[0][1][0] == 12
    tiny = leakage.Items.build([(3, "a b c d e f g h i j k l")])
    assert tiny.search(["x a b c d e f g h i j z"]) == [{3: (10, 10, 0)}]


def test_toxicity_on_held_out_rows(spark):
    random.seed(1)
    clean = ["La domanda va inviata entro maggio.", "Il contributo copre i costi di impianto.", "La commissione valuta il progetto.", "La piattaforma si blocca, che vergogna."]
    bad = {"abusive": ["Siete degli {} senza vergogna.", "Ma sei proprio un {}, chi ti vuole?"], "hateful": ["Gli stranieri sono {}, fuori tutti.", "Cacciate quei {} dal paese."], "sexual": ["Video {} gratis, clicca subito.", "Cerco {} in zona, scrivimi."]}
    word = {"abusive": ["idioti", "cretino", "stronzi"], "hateful": ["animali", "parassiti", "vermi"], "sexual": ["porno", "sesso", "orge"]}
    docs, labels, truth = [], [], {}
    for i in range(400):
        kind = random.choice(["clean", "clean", *bad])
        lines = random.choices(clean, k=3)
        if kind != "clean":
            lines.insert(random.randrange(4), random.choice(bad[kind]).format(random.choice(word[kind])))
        docs.append((i, "\n".join(lines), f"s{i % 3}", "clash"))
        truth[i] = kind
        if i < 250:
            labels += [(i, 1, kind if random.random() > 0.05 else "clean"), (i, 2, None)]
    docs += [(900, None, "s0", "c"), (901, "", None, "c")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string, label string")
    noted = spark.createDataFrame(labels, "doc_id bigint, annotator int, label string")
    scored = toxicity.score_documents(frame, toxicity.fit(frame, noted))
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == 402 and rows[900].abusive == 0 and rows[901].spans == []
    held = [(truth[i], {s for s in toxicity.STATES[1:] if rows[i][s] >= toxicity.THRESHOLD}) for i in range(250, 400)]
    assert np.mean([got == ({kind} - {"clean"}) for kind, got in held]) >= 0.9
    for r in rows.values():
        text = next(d[1] for d in docs if d[0] == r.doc_id)
        assert all(0 <= s.start < s.end <= len(text) for s in r.spans)
    rates = {r.source: r.documents for r in toxicity.source_rates(scored).collect()}
    assert sum(rates.values()) == 402 and None in rates


def random_field(words):
    field = toxicity.Field()
    rng = np.random.default_rng(3)
    field.t = rng.normal(size=(4, 4)).astype(np.float32)
    x = toxicity.pack(words)
    field.w[np.unique(x)] = rng.normal(size=(len(np.unique(x)), 4))
    field.w[0] = 0
    return field, x


def weigh(field, x, allowed):
    e = field.w[x].sum(1)
    total, whole = np.zeros((len(x), 4)), 0.0
    for path in itertools.product(range(4), repeat=len(x)):
        if allowed(path):
            s = np.exp(sum(e[k, y] for k, y in enumerate(path)) + sum(field.t[a, b] for a, b in zip(path, path[1:])))
            whole += s
            for k, y in enumerate(path):
                total[k, y] += s
    return total / whole, whole


def test_marginals_equal_enumeration():
    field, x = random_field(["uno", "due", "tre"])
    assert np.allclose(field.marginals([x])[0], weigh(field, x, lambda p: True)[0], atol=1e-4)
    whole = weigh(field, x, lambda p: True)[1]
    some = [1 - weigh(field, x, lambda p, k=k: k not in p)[1] / whole for k in (1, 2, 3)]
    assert np.allclose(field.sentences([x])[0, 1:], some, atol=1e-4)
    # what a bad label tells: at least one token in its state, the others in it or clean
    _, valid, e = field.emissions([x, x])
    q, _ = field.observed(e, valid, np.array([2, 0]))
    assert np.allclose(q[0], weigh(field, x, lambda p: 2 in p and set(p) <= {0, 2})[0], atol=1e-4)
    assert (q[1][:, 0] == 1).all()


def test_batched_scores_equal_single_ones_and_a_field_can_be_stored():
    words = ["uno", "due", "tre", "quattro"]
    field, x = random_field(words)
    again = toxicity.Field.load(field.dump())
    found, some = toxicity.Scorer(again).marginals([("altro",), tuple(words), ("due", "due")])
    assert np.allclose(found[1], field.marginals([x])[0], atol=1e-4) and np.allclose(some[1], field.sentences([x])[0, 1:], atol=1e-4)


def test_without_labels_nothing_is_found(spark):
    docs = spark.createDataFrame([(1, "Vaffanculo idioti.", "s"), (2, "La domanda va inviata.", "s")], "doc_id bigint, text string, source string")
    none = spark.createDataFrame([], "doc_id bigint, annotator int, label string")
    assert toxicity.categories(toxicity.score_documents(docs, toxicity.fit(docs, none))).count() == 0


def test_found_queries_have_the_columns_asked_for(spark, data):
    want = {"p1_found": ["group_id", "field", "grant_id"], "p2_found": ["page_id", "line_no"], "p4_found": ["grant_id", "reg_id"], "p5_found": ["spelling_id_a", "spelling_id_b"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id", "category"]}
    for name, columns in want.items():
        rows = queries.QUERIES[name](spark, data)
        assert rows.columns == columns
        assert rows.count() == rows.distinct().count(), name


def test_pairs_of_titles_compare_each_pair_of_words_once(monkeypatch):
    import random

    from vaglio.functions import distance
    from vaglio.llm import linkage

    random.seed(6)
    words = ["".join(random.choices("aeilmnort", k=random.randint(4, 11))) for _ in range(25)]
    words += [w[:2] + w[3] + w[2] + w[4:] for w in words]
    compared = []
    exact = distance.weighted_edit
    monkeypatch.setattr(linkage, "weighted_edit", lambda a, b, *limit: compared.append((a, b)) or exact(a, b, *limit))
    titles = [random.sample(words, 3) for _ in range(150)]
    for a in titles:
        for b in titles:
            linkage.word_overlap(a, b)
    assert compared and len(compared) == len(set(compared))
    for a in words:
        for b in words:
            for limit in (1, 1.5, 2):
                assert (exact(a, b, limit) <= limit) == (exact(a, b) <= limit)
                assert exact(a, b, limit) in (exact(a, b), float("inf"))
