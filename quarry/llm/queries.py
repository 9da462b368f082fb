"""Registered queries of the operators, and their SQL where SQL can say it."""

from quarry.llm import chat, decontam, html, langid, licenses, linededup, packing, phrases, quality, runs, secrets, simhash, warc

QUERIES = {
    "op1_langid": langid.op1_langid,
    "op2_simhash": simhash.op2_simhash,
    "op3_packing": packing.op3_packing,
    "op4_html": html.op4_html,
    "op5_decontam": decontam.op5_decontam,
    "op6_warc": warc.op6_warc,
    "op7_secrets": secrets.op7_secrets,
    "op8_quality": quality.op8_quality,
    "op9_chat": chat.op9_chat,
    "op10_linededup": linededup.op10_linededup,
    "op11_runs": runs.op11_runs,
    "op12_licenses": licenses.op12_licenses,
    "op13_phrases": phrases.op13_phrases,
}

ORACLE: dict[str, str] = {
    "op5_decontam": decontam.OP5_SQL,
    "op10_linededup": linededup.OP10_SQL,
    "op6_warc": warc.OP6_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
