"""speechlake: table and stream jobs over transcribed and recorded speech, on PySpark."""
