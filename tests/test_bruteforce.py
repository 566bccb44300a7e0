"""Queries without a SQL oracle, checked against a plain-Python brute force on the smallest tables."""

import unicodedata

import numpy as np
import pyarrow.parquet as pq

import __spark_entry__ as E
from conftest import SF_SMALL
from recoda.functions import constants as K
from recoda.operators.infer import letter_count_embedder
from recoda.plans import jobs
from recoda.sources.templates import load_template


def test_text_nfkc_docs_whole_texts(spark):
    got = {r["doc_id"]: r["text_nfkc"] for r in E.queries()["text_nfkc_docs"](spark, SF_SMALL).collect()}
    docs = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(docs)
    for d in docs:
        want = unicodedata.normalize("NFKC", d["text"]) if d["text"] is not None else None
        assert got[d["doc_id"]] == want


def _activity(r):
    t = r["libelle"]
    t = t.lower() if (t.upper() == t and t.lower() != t) else t
    if r["activ_sec_agri_et"]:
        t += K.AGRI_LINE_PREFIX + r["activ_sec_agri_et"].lower()
    if r["activ_nat_lib_et"]:
        t += K.NATURE_LINE_PREFIX + r["activ_nat_lib_et"].lower()
    return t


def test_prompts_retrieval_matches_brute_force(spark):
    got = {r["liasse_numero"]: r for r in E.queries()["prompts_retrieval"](spark, SF_SMALL).collect()}
    ws = [r.asDict() for r in jobs.workset(spark, SF_SMALL).collect()]
    docs = [r.asDict() for r in jobs.q_label_documents(spark, SF_SMALL).collect()]
    docs.sort(key=lambda d: d["code"])
    emb = letter_count_embedder()
    dmat = np.asarray(emb([d["content"] for d in docs]), dtype=np.float32).astype(np.float64)
    dmat = dmat / np.linalg.norm(dmat, axis=1, keepdims=True)
    tpl = load_template(None, "retrieval-classifier")
    rtpl = load_template(None, "retriever")
    assert set(got) == {r["liasse_numero"] for r in ws}
    for r in ws:
        act = _activity(r)
        q = np.asarray(emb([rtpl["user"].replace("{{activity_description}}", act)]), dtype=np.float32).astype(np.float64)[0]
        q = q / np.linalg.norm(q)
        scores = dmat @ q
        order = sorted(range(len(docs)), key=lambda i: (-scores[i], docs[i]["code"]))[: K.TOP_K]
        codes = [docs[i]["code"][:2] + "." + docs[i]["code"][2:] for i in order]
        block = "\n\n".join(K.RETRIEVED_DOC_PREFIX + docs[i]["content"] for i in order)
        listed = ", ".join(f"'{c}'" for c in codes)
        want = (tpl["user"].replace("{{proposed_codes}}", block)
                .replace("{{list_proposed_codes}}", listed).replace("{{activity}}", act))
        row = got[r["liasse_numero"]]
        assert row["proposed_codes"] == listed
        assert row["user_prompt"] == want
