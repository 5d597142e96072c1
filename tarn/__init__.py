"""tarn: order, sign-in and message analytics as lazy Spark DataFrame functions."""
