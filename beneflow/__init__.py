"""Monthly public-benefit payments as Spark jobs: landing, bronze, silver and gold layers."""
