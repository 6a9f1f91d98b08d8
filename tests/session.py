import tempfile

from pyspark.sql import SparkSession


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tickloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
