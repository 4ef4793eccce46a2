from pyspark.sql import SparkSession


def make_session(partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tidesift-tests")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
