"""Operators on large text corpora for training data, their queries and their SQL."""

from leafwright.llm import centroids, overlaps
from leafwright.llm.centroids import op11_centroids
from leafwright.llm.dialogues import op12_dialogue_repair
from leafwright.llm.edits import op6_edit_counts
from leafwright.llm.mixing import op8_mixing
from leafwright.llm.overlaps import op13_jaccard_join
from leafwright.llm.packing import op10_packing
from leafwright.llm.paragraphs import op9_paragraphs
from leafwright.llm.phrases import op7_fingerprints
from leafwright.llm.quality import op3_quality
from leafwright.llm.repeats import op2_substrings
from leafwright.llm.simhash import op5_simhash
from leafwright.llm.topk import op4_top_k
from leafwright.llm.toxicity import op1_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_substrings, op3_quality, op4_top_k, op5_simhash, op6_edit_counts, op7_fingerprints,
        op8_mixing, op9_paragraphs, op10_packing, op11_centroids, op12_dialogue_repair,
        op13_jaccard_join,
    )
}
SQL: dict[str, str] = {"op11_centroids": centroids.SQL, "op13_jaccard_join": overlaps.SQL}
