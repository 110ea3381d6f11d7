import corpus_pipeline as C
from dossier.llm.common import table

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in C.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    assert not docs.where("text rlike '[a-z]@mail[0-9]'").count()
    packed = C.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
