"""finmart: bank-sector open-data ETL and analysis as PySpark DataFrame jobs."""
