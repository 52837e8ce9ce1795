"""paperloom: article ETL, text cleaning and reporting as Spark jobs."""
