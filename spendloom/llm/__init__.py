"""Operations for training-data pipelines: packing, de-duplication, classifiers, encoders, scans."""
