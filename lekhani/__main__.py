from pyspark.sql import SparkSession

from lekhani.plans.cli import run

if __name__ == "__main__":
    run(SparkSession.builder.appName("lekhani").getOrCreate())
