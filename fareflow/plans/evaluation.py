"""Quality of a saved model on the held-out share of the cleaned table."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from fareflow.operators.metrics import evaluation_record, regression_metrics
from fareflow.operators.model import predict
from fareflow.operators.split import hash_split
from fareflow.sources.tables import write_record


def evaluate_cleaned(
    model: PipelineModel, cleaned: DataFrame, record_path: str | None = None, train_percent: int = 80
) -> DataFrame:
    """One-row evaluation record; the test share is scanned and scored once."""
    _, test = hash_split(cleaned, train_percent)
    record = evaluation_record(regression_metrics(predict(model, test)))
    if record_path:
        write_record(record, record_path)
        return cleaned.sparkSession.read.schema(record.schema).json(record_path)
    return record
