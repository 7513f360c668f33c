import pytest
from pyspark.sql import functions as F

from retailpulse.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_hilbert_codes", "op13_zone_centroids"])
def test_vector_queries_return_a_row_for_each_usable_embedding(spark, tmp_path, name):
    """These two read `embeddings`, not `documents`, and drop vectors that are null or not finite."""
    vectors = spark.read.parquet(f"{DATA}/embeddings.parquet")
    assert [r.vec_id for r in QUERIES[name](spark, DATA).select("vec_id").orderBy("vec_id").collect()] == [
        r.vec_id for r in vectors.select("vec_id").orderBy("vec_id").collect()
    ]
    item = vectors.schema["embedding"].dataType.elementType
    first = vectors.orderBy("vec_id").limit(1)
    nulls = first.withColumns({"vec_id": F.lit(-1).cast("long"), "embedding": F.lit(None).cast(vectors.schema["embedding"].dataType)})
    odd = F.transform("embedding", lambda x, i: F.when(i == 0, F.lit(float("nan")).cast(item)).otherwise(x))
    nans = first.withColumns({"vec_id": F.lit(-2).cast("long"), "embedding": odd})
    vectors.unionByName(nulls).unionByName(nans).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    assert found.count() == vectors.count() and not found.where("vec_id < 0").count()
