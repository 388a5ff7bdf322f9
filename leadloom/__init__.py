"""leadloom: partner lead intake, validation, status and reporting on PySpark DataFrames."""
