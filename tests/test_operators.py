import json
import zipfile

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from entwine.functions import similarity as S
from entwine.operators import audit, blocking, checkpoints, evaluate, features, models, split, validate
from entwine.operators.normalize import clean_records
from entwine.sources import files, tables

ENTITY = "entity_id string, business_name string, business_address string, country string"
PAIR = "s1_entity_id string, target_entity_id string"


def column(spark, items):
    return spark.createDataFrame([(x,) for x in items], "x string")


def ids(spark, items):
    return spark.createDataFrame([(x,) for x in items], "s1_entity_id string")


def pairs(spark, *items):
    return spark.createDataFrame(list(items), PAIR)


def test_audit(spark):
    got = audit.text_stats(column(spark, ["one two three", "four", "four", "", None]), "x").first()
    assert got.asDict() == {"count": 3, "missing": 2, "unique_count": 2, "char_len_min": 4, "char_len_max": 13, "token_count_mean": 5 / 3}
    row = ("S1_a", "Quill Works", "5 Pier Rd", "PT")
    got = audit.table_audit(spark.createDataFrame([row, row, row, ("S1_a", "Quill", "5 Pier Rd", "PT"), ("S1_b", "Fern", "", "IE")], ENTITY)).first()
    assert (got.num_rows, got.num_cols, got.unique_entity_ids, got.duplicate_entity_ids, got.total_exact_duplicate_rows) == (5, 4, 2, 3, 2)
    truth = pairs(spark, ("S1_a", "S2_1"), ("S1_a", "S2_2"), ("S1_a", "S3_1"), ("S1_b", "S3_9"))
    got = audit.truth_cardinality(truth, ids(spark, ["S1_a", "S1_b", "S1_c", "S1_d", "S1_e"])).first()
    assert (got.total_s1, got.singletons_count, got.singletons_pct, got.one_to_one, got.one_to_many, got.max_matches, got.matched_targets_source2, got.matched_targets_source3) == (5, 3, 60.0, 1, 1, 3, 2, 2)


def test_exploration(spark):
    texts = column(spark, ["HARBOUR 9", "moss, fern", "Blue-Green Kites", "kItE", "42", "", None])
    assert {r.casing: r.n for r in audit.casing_distribution(texts, "x").collect()} == {"all_uppercase": 1, "all_lowercase": 1, "title_case": 1, "mixed": 1, "none": 1}
    assert {r.mark: r.n for r in audit.punctuation(texts, "x").collect()} == {",": 1, "-": 1}
    places = column(spark, ["Pier 7, 4700-11", "Lane 90210-4433", "560017 Ring Rd, Apt 3", "Nowhere"])
    assert list(audit.address_patterns(places, "x").first()) == [75.0, 25.0, 25.0]
    assert {r.token: r.n for r in audit.address_abbreviations(places, "x").collect()} == {"rd": 1, "apt": 1}
    names = column(spark, ["Otter GmbH", "Elk Ltd.", "Heron Pvt Ltd", "Vole GmbH", "Limited Edition", "Newt"])
    assert {r.suffix: (r.n, r.pct) for r in audit.suffix_frequency(names, "x").collect()} == {"gmbh": (2, 33.33), "ltd.": (1, 16.67), "pvt ltd": (1, 16.67)}
    assert [tuple(r) for r in audit.frequent_tokens(column(spark, ["b a", "A c", "c b a"]), "x", 2).collect()] == [("a", 3), ("b", 2)]


def sides(spark):
    s1 = [("S1_1", "Otter Boat Hire GmbH", "3 Quay St 20457", "Germany"), ("S1_2", "Blue Kite School", "8 Dune Rd", "Portugal"), ("S1_3", "Zzyzx", "none", "Peru")]
    targets = [("S2_1", "Otter Boat Hire Ltd", "3 Quay Street 20457", "Germany"), ("S3_1", "Otter Boats", "elsewhere 20457", "DE"), ("S3_2", "Kite School Blue", "8 Dune Road", "Portugal")]
    return tuple(clean_records(spark.createDataFrame(x, ENTITY)) for x in (s1, targets))


def test_blocking(spark):
    s1, t = sides(spark)
    got = {(r.s1_entity_id, r.target_entity_id): (r.rank, set(r.rules)) for r in blocking.candidates(s1, t).collect()}
    assert got == {
        ("S1_1", "S2_1"): (1, {"rule_clean_name", "rule_exact_addr", "rule_prefix_tokens", "rule_rare_token", "rule_postal_digits", "rule_char_3gram"}),
        ("S1_1", "S3_1"): (2, {"rule_rare_token", "rule_char_3gram"}),
        ("S1_2", "S3_2"): (1, {"rule_exact_addr", "rule_rare_token"}),
    }
    assert {(r.s1_entity_id, r.target_entity_id) for r in blocking.candidates(s1, t, max_candidates=1).collect()} == {("S1_1", "S2_1"), ("S1_2", "S3_2")}
    assert {tuple(r) for r in blocking.rule_hits(s1, t, 5).collect()} == set(got) and blocking.rule_hits(s1, t, 5, max_block=1).count() == 2
    assert blocking.candidates(s1, t, max_block=0).count() == 0
    again = blocking.candidates(s1.repartition(3), t.repartition(3)).collect()
    assert {(r.s1_entity_id, r.target_entity_id): (r.rank, set(r.rules)) for r in again} == got
    assert list(blocking.summary(s1, blocking.candidates(s1, t)).first()) == [3, 1.0, 2]


def test_inverted_index(spark):
    rows = spark.createDataFrame([("a", ["xy", "x", "zz"]), ("b", ["xy"]), ("c", [])], "entity_id string, words array<string>")
    assert sorted(map(tuple, blocking.inverted_index(rows, F.col("words")).collect())) == [("xy", "a"), ("xy", "b"), ("zz", "a")]


def test_features(spark):
    s1, t = sides(spark)
    asked = spark.createDataFrame([("S1_1", "S2_1", ["rule_exact_addr", "rule_rare_token"]), ("S1_2", "S2_gone", ["rule_exact_name"])], PAIR + ", rules array<string>")
    found = features.pair_features(asked, s1, t)
    assert len(features.feature_names(found)) == 37
    got = {r.s1_entity_id: r for r in found.collect()}
    one, two = got["S1_1"], got["S1_2"]
    # otter boat hire gmbh / otter boat hire ltd: 16 shared characters in order, of 20 and 19
    assert (one.name_norm_exact_match, one.name_clean_exact_match, one.name_levenshtein_ratio, one.name_token_set_ratio) == (0.0, 1.0, round(2 * 16 / 39, 4), 1.0)
    assert (one.addr_norm_exact_match, one.addr_exact_match, one.addr_postal_pin_match, one.country_norm_match, one.strong_agreement_indicator, one.is_source2) == (1.0, 0.0, 1.0, 1.0, 1.0, 1.0)
    assert (one.num_rules_triggered, one.rule_exact_addr_flag, one.rule_exact_name_flag, one.name_len_diff_abs, one.name_token_count_diff) == (2, 1.0, 0.0, 0, 0)
    assert (two.name_token_set_ratio, two.addr_numeric_overlap, two.addr_postal_pin_match, two.country_norm_match, two.rule_exact_name_flag) == (0.0, 0.0, 0.5, 0.0, 1.0)
    held = features.labelled(found, pairs(spark, ("S1_1", "S2_1")), ids(spark, ["S1_2"]))
    assert {(r.s1_entity_id, r.is_match, r.is_validation) for r in held.collect()} == {("S1_1", 1, 0), ("S1_2", 0, 1)}


def test_metrics(spark):
    truth = pairs(spark, ("a", "x"), ("a", "y"), ("b", "z"))
    found = pairs(spark, ("a", "x"), ("b", "q"), ("d", "q"), ("other", "x"))
    per = {r.s1_entity_id: (r.n_true, r.n_pred, r.tp, r.precision, r.recall, r.f_beta) for r in evaluate.entity_fbeta(ids(spark, ["a", "b", "c", "d"]), truth, found).collect()}
    assert per == {"a": (2, 1, 1, 1.0, 0.5, 0.625 / 0.75), "b": (1, 1, 0, 0.0, 0.0, 0.0), "c": (0, 0, 0, 1.0, 1.0, 1.0), "d": (0, 1, 0, 0.0, 0.0, 0.0)}
    got = evaluate.macro_fbeta(ids(spark, ["a", "b", "c", "d"]), truth, found).first()
    assert (round(got.macro_f_beta, 9), got.num_singletons, got.singleton_accuracy, got.total_tp, got.total_fp, got.total_fn) == (round((0.625 / 0.75 + 1) / 4, 9), 2, 0.5, 1, 2, 2)


def test_recall(spark):
    truth = pairs(spark, ("a", "S2_x"), ("a", "S3_y"), ("b", "S3_z"), ("c", "S2_w"), ("c", "T_v"))
    found = spark.createDataFrame([("a", "S2_x", ["r1"]), ("a", "S3_y", ["r1", "r2"]), ("c", "S2_w", ["r2"]), ("c", "S2_no", ["r3"])], PAIR + ", rules array<string>")
    got = evaluate.recall_breakdown(truth, found, ids(spark, ["c"])).first()
    assert (got.total_true_pairs, got.captured_true_pairs, got.overall_pct, got.train_pct, got.val_pct, got.source2_pct, got.source3_pct) == (5, 3, 60.0, 66.667, 50.0, 100.0, 50.0)
    assert {r.rule: (r.captured, r.coverage_pct, r.unique_pairs, r.unique_pct) for r in evaluate.rule_ablation(truth, found).collect()} == {"r1": (2, 40.0, 1, 20.0), "r2": (2, 40.0, 1, 20.0)}
    assert {tuple(r) for r in evaluate.missed_pairs(truth, found).collect()} == {("b", "S3_z"), ("c", "T_v")}
    assert [tuple(r) for r in evaluate.missed_sample(truth, found, 1).collect()] == [("b", "S3_z", "S3", 2)]
    assert [tuple(r) for r in evaluate.missed_sample(truth, found).orderBy("s1_entity_id").collect()][1] == ("c", "T_v", "OTHER", 2)


@pytest.mark.parametrize(("start", "end", "step"), [(0.2, 0.95, 0.1), (0.0, 1.0, 0.25), (0.5, 0.5, 0.1)])
def test_threshold_grid_is_what_each_threshold_gives(spark, start, end, step):
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "x", 0.1), ("a", "y", 0.4), ("a", "w", 0.9), ("b", "z", 0.5), ("b", "q", 0.75), ("d", "q", 0.3), ("gone", "x", 0.99), ("e", "u", 0.05)], PAIR + ", score double")
    truth, entities = pairs(spark, ("a", "x"), ("a", "y"), ("b", "z"), ("e", "u")), ids(spark, ["a", "b", "c", "d", "e"])
    grid = evaluate.threshold_grid(scored, entities, truth, start, end, step).collect()
    assert len(grid) == round((end - start) / step) + 1
    for r in grid:
        want = evaluate.macro_fbeta(entities, truth, models.matches(scored, r.threshold)).first()
        assert [round(x, 9) for x in (r.macro_f_beta, r.macro_precision, r.macro_recall)] == [round(x, 9) for x in (want.macro_f_beta, want.macro_precision, want.macro_recall)]
    best = evaluate.best_threshold(evaluate.threshold_grid(scored, entities, truth, start, end, step)).first()
    assert best.threshold == min((r.threshold for r in grid if round(r.macro_f_beta, 9) == max(round(g.macro_f_beta, 9) for g in grid)))


def test_split(spark):
    rows = [(f"S1_{i}", ["IE", "PT", "PE"][i % 3], "x") for i in range(300)]
    s1 = spark.createDataFrame(rows, "entity_id string, normalized_country string, original_country string")
    truth = pairs(spark, *[(f"S1_{i}", f"S2_{i}") for i in range(0, 300, 2)], *[(f"S1_{i}", f"S3_{i}") for i in range(0, 300, 4)])
    strata = split.strata(s1, truth)
    got = split.assigned(strata, 0.25, 7).collect()
    assert len(got) == len({r.entity_id for r in got}) == 300
    sizes = {}
    for r in got:
        sizes.setdefault(r.stratum, []).append(r.fold == "val")
    assert len(sizes) == 9 and all(sum(x) == round(len(x) * 0.25) for x in sizes.values())
    assert sorted(map(tuple, got)) == sorted(map(tuple, split.assigned(split.strata(s1.repartition(5), truth), 0.25, 7).collect()))
    assert {r.entity_id for r in got if r.fold == "val"} != {r.entity_id for r in split.assigned(strata, 0.25, 8).collect() if r.fold == "val"}
    assert sum(r.n for r in split.stats(split.assigned(strata)).collect()) == 300


def test_baseline_and_mining(spark):
    f = spark.createDataFrame([("a", "x", 80.0, 60.0, 1.0), ("a", "y", 20.0, 10.0, 1.0), ("b", "z", 50.0, 100.0, 0.0)], PAIR + ", name_token_set_ratio double, addr_token_set_ratio double, country_exact_match double")
    scored = models.baseline_scores(f, (0.5, 0.25, 0.25), 100.0)
    assert {r.target_entity_id: round(r.score, 9) for r in scored.collect()} == {"x": 0.8, "y": 0.375, "z": 0.5}
    assert {r.target_entity_id for r in models.matches(scored, 0.5).collect()} == {"x", "z"}
    rows = spark.createDataFrame([("a", "x", 1, 0), ("a", "y", 0, 0), ("b", "z", 0, 1), ("b", "w", 0, 0), ("b", "v", 1, 0)], PAIR + ", is_match int, is_validation int")
    guess = spark.createDataFrame([("a", "x", 0.7, 1), ("a", "y", 0.65, 0), ("b", "z", 0.6, 0), ("b", "w", 0.2, 0), ("b", "v", 0.1, 1)], PAIR + ", score double, is_match int")
    assert list(models.confusion(guess).first()) == [1, 2, 1, 1]
    wrong = lambda **k: sorted((r.target_entity_id, r.model_score) for r in models.hard_negatives(rows, guess, **k).collect() if r.is_hard_negative)
    assert wrong() == [("y", 0.65), ("z", 0.6)] and wrong(include_validation=False) == [("y", 0.65)] and wrong(threshold=0.0) == wrong()
    assert models.hard_negatives(rows, guess).count() == 7
    assert models.leaderboard([("m", 0.0), ("k", None), ("n", 0.2), ("a", 0.0)]) == [("n", 0.2), ("a", 0.0), ("m", 0.0), ("k", None)]


def labelled_rows(spark, n=120):
    """Pairs that one number mostly tells apart, with a second that says nothing; every third entity is held out."""
    rows = [(f"e{i}", f"t{i}", float(i % 2) + (i % 7) / 20, float(i % 5), i % 2 ^ int(i % 13 == 5), int(i % 3 == 0)) for i in range(n)]
    rows += [(f"e{i}", f"u{i}", 0.1 * (i % 3), float(i % 5), 0, int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, PAIR + ", strong double, noise double, is_match int, is_validation int")


def test_models(spark, tmp_path):
    rows = labelled_rows(spark)
    model = models.train(rows)
    assert models.rounds(model) < models.ROUNDS  # held-out rows end it
    weights = models.importances(model, features.feature_names(rows))
    assert weights[0][0] == "strong" and [n for n, _ in weights] == ["strong", "noise"]
    entities, truth = rows.select("s1_entity_id").filter("is_validation = 1").distinct(), rows.filter("is_match = 1 and is_validation = 1")
    mined = models.hard_negatives(rows, models.scores(model, rows), 0.5)
    best, _, results = models.compare(rows, entities, truth, kinds=("gbt", "logistic"), mined=mined)
    assert [n for n, _ in results] == ["gbt", "logistic", "gbt_mined", "logistic_mined"] and dict(results)[best] == max(v for _, v in results) > 0.8
    odd = models.matrix(spark.createDataFrame([("a", "x", "1.5", None, "1")], PAIR + ", p string, q double, is_match string")).first()
    assert (odd.p, odd.q, odd.is_match) == (1.5, 0.0, 1)
    root = str(tmp_path / "checkpoints")
    with pytest.raises(FileNotFoundError):
        checkpoints.chosen(root)
    assert checkpoints.save(model, root, 0.4, experiment="one")["is_best"] and not checkpoints.save(model, root, 0.3, experiment="two")["is_best"]
    assert checkpoints.experiments(root) == [("one", 0.4), ("two", 0.3)]
    found, about = checkpoints.chosen(root)
    assert about["experiment"] == "one" and checkpoints.metadata(f"{root}/latest")["experiment"] == "two" and len(about["environment"]["commit"]) > 0
    assert models.scores(found, rows).orderBy("target_entity_id").collect() == models.scores(model, rows).orderBy("target_entity_id").collect()
    files.write_text(f"{root}/best/metadata.json", "{")  # a broken checkpoint is no missing one
    with pytest.raises(json.JSONDecodeError):
        checkpoints.chosen(root)


def test_boosting_starts_few_jobs_and_grows_the_trees_of_spark_ml(spark):
    rows = labelled_rows(spark).persist()
    sc = spark.sparkContext
    sc.setJobGroup("fit", "fit")
    model = models.train(rows)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("fit")) < 15  # not some for each round
    theirs = models.classifiers()["gbt"].setValidationIndicatorCol("held")
    plain = Pipeline(stages=[VectorAssembler(inputCols=["strong", "noise"], outputCol="vector"), theirs]).fit(models.matrix(rows).withColumn("held", F.col("is_validation") == 1))
    assert models.rounds(model) == models.rounds(plain)
    a, b = ({tuple(r)[:2]: r.score for r in models.scores(m, rows).collect()} for m in (model, plain))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_features_of_odd_strings_are_those_of_the_expressions(spark):
    odd = ["", "a", "ab", "the the moss", "moss the fern", "x " * 200, "y x " * 90, "Ünï çödé 12", "çödé 𝒳𝒴 12 12", "tab\tand\nline  two", "q" * 64, "q" * 63 + "r", "fern " * 13 + "moss"]
    clean = [(f"{p}{i}", "", x, odd[(i * 5 + 1) % len(odd)] if i % 3 else "", "", odd[(i * 7 + 2) % len(odd)], str(i % 2) * (i % 3), "", " us" * (i % 2), "US" * (i % 4 > 1)) for p in ("S1_", "S2_") for i, x in enumerate(odd)]
    columns = ", ".join(f"{c} string" for c in features.CLEAN)
    one, two = (spark.createDataFrame([r for r in clean if r[0].startswith(p)], columns) for p in ("S1", "S2"))
    pairs = spark.createDataFrame([(f"S1_{i}", f"S2_{j}", ["rule_exact_name"]) for i in range(len(odd) + 1) for j in range(len(odd) + 1)], PAIR + ", rules array<string>")
    got = features.pair_features(pairs, one, two)
    side = lambda df, p, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in features.CLEAN[1:]])
    x = pairs.join(side(one, "a", "s1_entity_id"), "s1_entity_id", "left").join(side(two, "b", "target_entity_id"), "target_entity_id", "left").na.fill("")
    for p in "ab":
        x = x.withColumn(f"{p}_core", F.when(F.col(f"{p}_clean_name_no_suffix") != "", F.col(f"{p}_clean_name_no_suffix")).otherwise(F.col(f"{p}_normalized_name")))
        x = x.withColumn(f"{p}_all", F.trim(F.concat_ws(" ", f"{p}_core", f"{p}_normalized_address")))
    both = lambda f, c: F.round(f(F.col(f"a_{c}"), F.col(f"b_{c}")), 4)
    name, addr = "normalized_name", "normalized_address"
    want = {
        "name_levenshtein_ratio": both(S.edit_ratio, name), "name_token_sort_ratio": both(S.token_sort_ratio, name), "name_token_set_ratio": both(S.token_set_ratio, "core"), "name_jaccard_similarity": both(S.token_jaccard, "core"),
        "name_char_3gram_jaccard": both(S.ngram_jaccard, "core"), "addr_token_set_ratio": both(S.token_set_ratio, addr), "addr_levenshtein_ratio": both(S.edit_ratio, addr), "addr_char_3gram_jaccard": both(S.ngram_jaccard, addr),
        "addr_numeric_overlap": both(S.numeric_jaccard, addr), "addr_len_ratio": both(S.length_ratio, addr), "addr_token_count_diff": both(S.token_count_difference, addr), "combined_text_similarity": both(S.token_set_ratio, "all"), "addr_postal_pin_match": both(S.postal_agreement, "postal_code"),
    }
    key = ["s1_entity_id", "target_entity_id"]
    plain = {tuple(r)[:2]: tuple(r)[2:] for r in x.select(*key, *[c.cast("double").alias(n) for n, c in want.items()]).collect()}
    found = {tuple(r)[:2]: tuple(r)[2:] for r in got.select(*key, *[F.col(n).cast("double") for n in want]).collect()}
    assert found == plain and len(found) == (len(odd) + 1) ** 2


def test_validation(spark):
    m = spark.createDataFrame([("k1", "p1, p2"), ("k2", None)], "s1_entity_id string, matching_ids string")
    c = spark.createDataFrame([("k1", "p1,p2,q1"), ("k2", "")], "s1_entity_id string, candidate_ids string")
    s1, pool = (spark.createDataFrame([(x,) for x in items], "entity_id string") for items in (["k1", "k2"], ["p1", "p2", "q1"]))
    assert validate.issues(m, c, s1, pool).count() == 0
    assert not validate.columns_missing(m) and validate.columns_missing(m.select("matching_ids"))
    m = spark.createDataFrame([("k1", "q9,q9"), ("k1", "k2"), ("k7", "p1")], "s1_entity_id string, matching_ids string")
    c = spark.createDataFrame([("k1", "p1,p1"), ("k1", "")], "s1_entity_id string, candidate_ids string")
    got = sorted((r.issue, r.s1_entity_id, r.target_entity_id) for r in validate.issues(m, c, s1, pool).collect())
    assert got == [
        ("duplicate_s1_in_candidates", "k1", None), ("duplicate_s1_in_matches", "k1", None), ("duplicate_target_in_candidates", "k1", "p1"), ("duplicate_target_in_matches", "k1", "q9"),
        ("match_is_an_s1_entity", "k1", "k2"), ("match_not_a_target", "k1", "k2"), ("match_not_a_target", "k1", "q9"),
        ("match_not_in_candidates", "k1", "k2"), ("match_not_in_candidates", "k1", "q9"), ("match_not_in_candidates", "k7", "p1"), ("missing_s1_in_matches", "k2", None), ("unexpected_s1_in_matches", "k7", None),
    ]
    assert validate.issues(m, c, s1, pool.limit(0)).filter("issue = 'match_not_a_target'").count() == 0


def test_tables(spark, tmp_path):
    raw = tmp_path / "t.tsv"
    raw.write_text('Country\tENTITY_ID\tbusiness_address\tbusiness_name\nPT\te1\t"4\tPier"\t"say ""hi"""\n\t\t\t\nIE\te2\n', encoding="utf-8")
    assert [tuple(r) for r in tables.read_entities(spark, str(raw)).orderBy("entity_id").collect()] == [("e1", 'say "hi"', "4\tPier", "PT"), ("e2", "", "", "IE")]
    other = tmp_path / "other.tsv"
    other.write_text("a\tb\nx1\tfern\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_entities(spark, str(other)).collect()] == [("x1", "fern", "", "")]
    gt = spark.createDataFrame([("k", " p ,q, p,,"), (" m ", None), ("", "z")], "first string, second string")
    assert {tuple(r) for r in tables.truth_pairs(gt).collect()} == {("k", "p"), ("k", "q")} and tables.truth_pairs(gt, distinct=False).count() == 3
    lists = tables.joined_lists(tables.truth_entities(gt), tables.truth_pairs(gt))
    assert {r.s1_entity_id: r.matching_ids for r in lists.collect()} == {"k": "p,q", "m": ""}
    tables.write_tsv(lists.repartition(2), str(tmp_path / "lists"), "s1_entity_id")
    report = tables.pack({"out/lists.tsv": str(tmp_path / "lists"), "t.tsv": str(raw), "none.json": str(tmp_path / "none")}, str(tmp_path / "a.zip"), {"seed": 7})
    assert (report["included"], report["missing"]) == (["out/lists.tsv", "t.tsv"], ["none.json"])
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert z.read("out/lists.tsv").decode().split("\n")[:3] == ["s1_entity_id\tmatching_ids", "k\tp,q", 'm\t""'] and json.loads(z.read("info.json")) == {"seed": 7}
    back = tmp_path / "back"
    assert sorted(tables.unpack([str(tmp_path / "missing.zip"), str(tmp_path / "a.zip")], str(back))) == ["lists.tsv", "t.tsv"]
    (back / "t.tsv").write_text("mine")
    tables.unpack(str(tmp_path / "a.zip"), str(back))
    assert (back / "t.tsv").read_text() == "mine"
    tables.unpack(str(tmp_path / "a.zip"), str(back), force=True)
    assert (back / "t.tsv").read_text() == raw.read_text()
    with pytest.raises(FileNotFoundError):
        tables.unpack(str(tmp_path / "missing.zip"), str(back))
    (tmp_path / "ids.json").write_text('{"held": [" k", "m", "k"], "more": 1}')
    assert {r.s1_entity_id for r in tables.listed_ids(spark, str(tmp_path / "ids.json"), "held").collect()} == {"k", "m"} and tables.listed_ids(spark, str(tmp_path / "no.json"), "held").count() == 0
