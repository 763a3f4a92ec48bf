from pyspark.sql import functions as F

from lexspark import schemas
from lexspark.functions import legal
from lexspark.plans import flows
from lexspark.sources import stores
from lexspark.streaming.progress import RunLog

PAGES = [
    ("L", 1, "LEI Nº 1, DE 2020\nDispõe sobre testes.\nArt. 1º O teste segue o art. 5º da Lei nº 14.133/2021.\nI - primeiro;\nII - segundo."),
    ("L", 2, "Art. 2º A ementa da Lei nº 8.987, de 13 de fevereiro de 1995, passa a vigorar com a seguinte redação:\n“Art. 1º-A A concessão.” (NR)\nArt. 3º Fim."),
]
RULING = "ACÓRDÃO Nº 7/2021 - Plenário\nRelator: Ministro Fulano\nSUMÁRIO: PREGÃO.\n\nRELATÓRIO\n1. Um.\nVOTO\n1. Dois.\nACÓRDÃO Nº 7/2021\n9.1. conhecer.\n"


def test_statutes_end_to_end(spark):
    pages = spark.createDataFrame(PAGES, "document_id string, page_number int, text string")
    req = spark.createDataFrame([("L", "LEI", "1", 2020)], "document_id string, tipo_documento string, numero string, ano int")
    out = flows.ingest_pages(pages, req)
    rows = {r.node_id: r for r in out.chunks.collect()}
    assert {"leis:L#ART-001", "leis:L#INC-001-I", "leis:L#INC-001-II", "leis:L#ART-002", "leis:L#ART-003", "leis:L#ART-001@FULL"} <= set(rows)
    assert out.quarantine.count() == 0
    assert [c.target_node_id for c in rows["leis:L#ART-001"].citations] == ["leis:LEI-14.133-2021#ART-005"]
    assert rows["leis:L#ART-002"].origin_type == "external" and rows["leis:L#ART-002"].retrieval_text.startswith("Lei de Concessões (LEI-8987-1995)\n")
    assert rows["leis:L#ART-001"].origin_type == "self" and rows["leis:L#ART-001@FULL"].is_consolidated
    m = out.manifest.first()
    assert m.chunks == len(rows) and "LEI-8987-1995" in m.target_documents
    full = schemas.conform(out.chunks, schemas.CHUNKS)
    assert full.where("parent_text is null or citations is null").count() == 0 and full.where("dense_vector is not null").count() == 0
    index = stores.index_rows(out.chunks).collect()
    assert len(index) == len(rows) and all("@P" in r.node_id for r in index)


def test_rulings_end_to_end(spark):
    docs = spark.createDataFrame([("A", RULING), ("B", "sem quebra final")], "document_id string, text string")
    out = flows.ingest_rulings(docs)
    assert {r.span_id for r in out.chunks.collect()} == {"SEC-EMENTA", "SEC-RELATORIO", "SEC-VOTO", "SEC-ACORDAO"}
    assert out.manifest.count() == 1 and out.citations.count() == 0


def test_embedding_texts(spark):
    rows = [("article", "ART-005", "", "D | Art. 5 | Artigo\nt"), ("inciso", "INC-005-III", "caput", "D | Art. 5 | Inciso III\nt\n[CONTEXTO] caput"), ("paragraph", "PAR-005-UNICO", "", "D | Art. 5 | Parágrafo único\nt"), ("paragraph", "PAR-005-2", "", "D | Art. 5 | Parágrafo 2º\nt"), ("alinea", "ALI-005-I-a", "", "D | Art. 5 | Alínea a)\nt")]
    df = spark.createDataFrame(rows, "k string, s string, p string, want string")
    got = df.select("want", legal.embedding_text(F.lit("D"), F.lit("5"), F.col("k"), F.lit("t"), F.col("p"), F.col("s")).alias("g")).collect()
    assert all(r.want == r.g for r in got)
    n = spark.createDataFrame([("", "INC-014-I"), ("", "ART-123"), ("9", "ART-001"), ("", "x")], "n string, s string").select(legal.safe_article_number(F.col("n"), F.col("s")).alias("v"))
    assert [r.v for r in n.collect()] == ["14", "123", "9", ""]


def test_structured_pages_and_progress(spark, tmp_path):
    good = '```json\n{"page_number": 2, "devices": [{"device_type": "artigo", "identifier": "Art. 1", "text": "x", "parent_identifier": "", "bbox": [0.1, 0.2, 0.5, 1.0], "confidence": 0.9}]}\n```'
    a = spark.createDataFrame([("D", good), ("D", "nothing")], "document_id string, answer string")
    got = stores.structured_pages(a, 100.0, 200.0).collect()
    assert len(got) == 1 and got[0].bbox == [10.0, 40.0, 50.0, 200.0] and got[0].page_number == 2
    log = RunLog()
    spark.streams.addListener(log)
    q = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", str(tmp_path)).start()
    q.processAllAvailable()
    q.stop()
    q.awaitTermination(30)
    spark.streams.removeListener(log)
