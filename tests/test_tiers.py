from custseg.operators import tiers


def test_tiers_and_segments(spark):
    # quartiles of 1..8 with linear interpolation: 2.75, 4.5, 6.25
    rows = [(i, float(9 - i), float(i), float(i)) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "customer_id long, recency double, frequency double, monetary double")
    out = {r.customer_id: r for r in tiers.rfm_tiers(df).collect()}
    assert out[1].frequency_tier == 0 and out[1].recency_tier == 0 and out[1].segment is None
    assert out[8].frequency_tier == 3 and out[8].recency_tier == 3 and out[8].rfm_score == 9
    assert out[8].segment == "top" and out[5].rfm_score == 6 and out[5].segment == "medium"
