from marquee.plans.views import create_user_view, user_view


def test_masked_and_unmasked_user_view(spark):
    dim = spark.createDataFrame(
        [(1, "Ann", "ann@example.com", "+919876543210", "X", None, None, None, True),
         (2, "Bob", "no-at-sign.example.com", "12", "Y", None, None, None, True),
         (3, "Cy", None, None, "Z", None, None, None, True),
         (4, "Di", "@example.com", "12345", "Z", None, None, None, True)],
        "user_id long, name string, email string, phone string, city string, signup_date timestamp_ntz, "
        "effective_start timestamp_ntz, effective_end timestamp_ntz, is_current boolean",
    )
    masked = {r.user_id: (r.email, r.phone) for r in user_view(dim).collect()}
    assert masked[1] == ("a***@example.com", "******3210")
    assert masked[2] == ("***", "******")
    assert masked[3] == (None, None)
    assert masked[4] == ("***", "******2345")
    assert "name" not in user_view(dim).columns
    raw = {r.user_id: (r.email, r.phone) for r in user_view(dim, privileged=True).collect()}
    assert raw[1] == ("ann@example.com", "+919876543210")


def test_sql_view_matches_dataframe_view(spark):
    dim = spark.createDataFrame(
        [(1, "Ann", "ann@example.com", "+919876543210", "X", None, None, None, True),
         (2, "Bob", "no-at-sign.example.com", "12", "Y", None, None, None, True)],
        "user_id long, name string, email string, phone string, city string, signup_date timestamp_ntz, "
        "effective_start timestamp_ntz, effective_end timestamp_ntz, is_current boolean",
    )
    dim.createOrReplaceTempView("test_dim_user")
    sql_view = create_user_view(spark, "test_dim_user", "test_dim_user_masked")
    assert sorted(map(tuple, sql_view.collect())) == sorted(map(tuple, user_view(dim).collect()))
