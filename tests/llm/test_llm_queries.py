from testbed import compare

from pingloom.llm import queries


def test_sql_gives_the_same_rows(spark, sf_dir):
    con = compare.connect(sf_dir)
    for name, sql in queries.ORACLE.items():
        assert compare.differences(spark, con, queries.ALL[name], sql, sf_dir) is None


def test_names_and_columns(spark, sf_dir):
    wanted = {
        1: "doc_id source slot", 2: "doc_id item_id", 3: "page_id url text n_chars",
        4: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        5: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        6: "doc_id held_out n_tokens n_known train_tokens base_score score",
        7: "doc_id n_assign n_access n_hex base_sha256 spans", 8: "doc_id n_shingles component_id kept",
        9: "doc_id start n_tokens ids_crc32", 10: "doc_id n_bytes n_removed n_spans kept_sha256",
        11: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
        12: "vec_id cluster distance cluster_inertia inertia centroid_sha256", 13: "word form root n n_near form_n",
    }
    by_number = {int(n.split("_")[0][2:]): q for n, q in queries.ALL.items()}
    assert set(by_number) == set(wanted)
    for number, columns in wanted.items():
        assert set(columns.split()) <= set(by_number[number](spark, sf_dir).columns), number
