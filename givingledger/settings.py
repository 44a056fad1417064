"""Session settings that suit the export. Apply them when the session is built."""

SESSION_SETTINGS = {
    # Splits frequent join keys, merges small shuffle partitions, picks joins by actual size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The export has some 250 generated classes; the default cache of 100 would compile them anew
    # in every run.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # The JVM never compiles methods of more than 8000 bytes. Above that, separate operators are
    # faster than one fused stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
