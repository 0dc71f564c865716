"""Which of the training-data queries have no SQL twin, and why."""

from __future__ import annotations

from __spark_entry__ import LLM, LLM_TWINS

WITHOUT_TWIN = {
    "op1_kd_sharding": "cuts depend on narrowed histograms; balance and gapless slots are tested",
    "op2_rule_quality": "a fitted model; held-out accuracy is tested",
    "op4_suffix_repeats": "suffix order and extension; tested against brute force",
    "op5_template_decontamination": "templates of words; tested against brute force",
    "op6_text_density": "a page tree; tested against hand-made pages",
    "op7_ngram_bitmask": "a fitted filter; held-out accuracy is tested",
    "op9_simhash_bktree": "XXH64 is not in SQL; tested against brute force",
    "op10_token_files": "a tokenizer and binary files; tested by encoding whole texts",
    "op12_incremental_whitening": "eigenvectors; tested against a dense solver",
    "pipeline": "holds the above; stages are tested one by one",
}


def test_what_has_no_twin_has_a_reason():
    assert set(LLM) - set(LLM_TWINS) == set(WITHOUT_TWIN) & set(LLM)
